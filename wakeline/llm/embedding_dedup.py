"""Near-duplicate vectors: binary codes of randomly rotated vectors decide which pairs are computed exactly.

Each unit vector x is rotated and coded by the signs of its coordinates; c(x) is the code as a unit vector and
f(x) = <x, c(x)> its stored correction factor. <c(x), y> / f(x) is an unbiased estimate of <x, y> over the
rotation, with a confidence bound of EPSILON * sqrt((1 - f^2) / (f^2 (d - 1))); besides, the angles of x, c(x)
and y bound <x, y> without any doubt. Pairs whose upper bound stays below the threshold are left out, all
others are recomputed in double precision from the vectors.

The rows of one label are dealt to blocks, and each pair of blocks is a task: a label with a third of all rows
spreads over as many tasks as any other rows. Tasks return counts and spanning links, never all their pairs.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, grouped
from .components import components

#: The confidence bound's width: an error beyond it has a probability of about exp(-EPSILON**2 / 2), 1e-9.
EPSILON = 6.5
_OUT = "vec_id long, n_links long, root long"


@lru_cache(8)
def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(20_24).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign codes of unit vectors, and their correction factors."""
    turned = unit @ rotation(unit.shape[1])
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(1) / np.sqrt(unit.shape[1])


def upper_bounds(code: np.ndarray, factor: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of all inner products of coded with other unit vectors, and bounds that they stay below."""
    d = other.shape[1]
    signs = (np.unpackbits(code, axis=1, count=d).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(d))
    t = signs @ (other @ rotation(d)).astype(np.float32).T
    f = factor.astype(np.float32)[:, None]
    estimate = t / f
    likely = estimate + EPSILON * np.sqrt((1 - f * f).clip(0) / (f * f * max(d - 1, 1)))
    certain = np.where(t >= f, np.float32(1), t * f + np.sqrt((1 - t * t).clip(0) * (1 - f * f).clip(0)))
    return estimate, np.minimum(likely, certain) + np.float32(1e-4)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that squares neither overflow nor vanish; cosines stay exactly the same."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _encode(batches):
    for batch in batches:
        col = batch.column(1)
        size = col.value_lengths().to_numpy(zero_copy_only=False)
        out = [(None, None)] * len(batch)
        for d in np.unique(size):
            at = np.flatnonzero(size == d)
            x = np.array(col.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(at), int(d))
            x = _scaled(x)
            unit = x / np.sqrt((x * x).sum(1, keepdims=True))
            code, factor = codes(unit)
            for i, c, f in zip(at, code, factor):
                out[i] = (c.tobytes(), float(f))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.float64())], [*batch.schema.names, "code", "factor"])


def _links(ids, x, code, factor, ids2, x2, threshold):
    """Index pairs whose exact cosine is the threshold at least."""
    norm, norm2 = np.sqrt((x * x).sum(1)), np.sqrt((x2 * x2).sum(1))
    rows, cols = [], []
    for at in range(0, len(x), 512):
        _, upper = upper_bounds(code[at : at + 512], factor[at : at + 512], x2 / norm2[:, None])
        i, j = np.nonzero(upper >= threshold)
        i += at
        keep = ids[i] < ids2[j] if ids is ids2 else ids[i] != ids2[j]
        i, j = i[keep], j[keep]
        for k in range(0, len(i), 1 << 16):
            a, b = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            hit = np.einsum("ij,ij->i", x[a], x2[b]) / (norm[a] * norm2[b]) >= threshold
            rows.append(a[hit])
            cols.append(b[hit])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *rows]), np.concatenate([empty, *cols])


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches by the links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        nxt = root.copy()
        np.minimum.at(nxt, root[a], low)
        np.minimum.at(nxt, root[b], low)
        nxt = nxt[nxt]
        if (nxt == root).all():
            return root
        root = nxt


def _pairs(key, rows: pa.Table, threshold: float) -> pa.Table:
    first, second = key[2].as_py(), key[3].as_py()
    rows = rows.sort_by("vec_id")
    d = key[1].as_py()
    x = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), d)
    x = _scaled(x)
    ids, block = rows.column("vec_id").to_numpy(), rows.column("block").to_numpy()
    code = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(rows), -1)
    factor = rows.column("factor").to_numpy()
    if first == second:
        a, b = _links(ids, x, code, factor, ids, x, threshold)
    else:
        p, q = np.flatnonzero(block == first), np.flatnonzero(block == second)
        a, b = _links(ids[p], x[p], code[p], factor[p], ids[q], x[q], threshold) if len(p) and len(q) else (p[:0], q[:0])
        a, b = p[a], q[b]
    n = np.bincount(a, minlength=len(rows)) + np.bincount(b, minlength=len(rows))
    linked = np.flatnonzero(n)
    root = roots(len(rows), a, b)
    return pa.table({"vec_id": ids[linked], "n_links": n[linked].astype(np.int64), "root": ids[root[linked]]})


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.93, block_rows: int = 2048) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept.

    Rows of one label (not null) and one dimension are linked if their cosine is threshold at least. Vectors that
    are null, empty, all zero, or hold null or non-finite components, and rows with no id, link with nothing. Of
    rows that repeat an id, only the least (label, vector) counts. n_links counts the other vectors linked
    directly, component_id is the smallest id that links reach. A row with no id has no component and is kept.
    An empty table gives an empty result; other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    named = rows.filter("vec_id is not null").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("s")).select("vec_id", "s.label", "s.v")
    fit = "label is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)"
    good = named.filter(fit).select("vec_id", "v", "label", F.size("v").alias("d"))
    coded = durable(good.mapInArrow(_encode, "vec_id long, v array<double>, label string, d int, code binary, factor double"))
    blocks = coded.groupBy("label", "d").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    dealt = coded.join(blocks, ["label", "d"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other")).drop("other", "blocks")
    found = durable(dealt.groupBy("label", "d", "first", "second").applyInArrow(grouped(_pairs, threshold=threshold), _OUT))
    counts = found.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))
    part = components(found, "vec_id", "root")
    out = named.select("vec_id").join(counts, "vec_id", "left").join(part.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    nameless = rows.filter("vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionAll(nameless).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
