"""Jaccard join of texts on word shingles, by a MinHash LSH forest with exact verification.

Every text has a label, a sequence of MinHash values, in each of TREES prefix trees. Texts with an equal prefix are a run of
the tree's sorted labels, a node of its trie. All start with a prefix one longer than the one with which a pair right at
the threshold is sure to be met; how far it is shortened depends on the runs: a text may keep the long prefix in so many
trees as the target recall allows, does so where its runs are largest, and a run is shortened if any of its texts asks for
that. So every text reaches the recall with as few, as small runs as the data allow.

Texts with equal shingle sets are one node. The sets of a run come together and all pairs in it that no run of an earlier
tree has are verified exactly, as matrix products. A run whose texts all share a run in an earlier tree is left out. A large
run is dealt to blocks (by texts and by shingles) and each pair of blocks is a task. Tasks return link counts and spanning
links, never the pairs; only verified links make classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import binary_array, broadcast_if_small, buffers, discard, durable, grouped, hash_words, mix, window_hashes
from .components import components, spread_join
from .embedding_dedup import roots

TREES, DEPTH, RECALL = 36, 8, 0.999_999
#: Shingles of a task, and of a block of a large run.
PACK_SHINGLES, BLOCK_SHINGLES = 1 << 19, 1 << 20
MOST_TASKS = 50_000
_FOUND = "node long, n_links long, n_texts long, root long"


def prefix_depth(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix with which a pair at the threshold meets in some tree with the target recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def spare_trees(threshold: float, depth: int, trees: int = TREES, recall: float = RECALL) -> int:
    """In how many trees a text may keep a prefix of depth + 1 and still meet a pair at the threshold with the target recall."""
    n = 0
    while n < trees and 1 - (1 - threshold**depth) ** (trees - n - 1) * (1 - threshold ** (depth + 1)) ** (n + 1) >= recall:
        n += 1
    return n


def shingle_sets(texts: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts end to end, sorted for each text, and the bounds of each text.

    A text with fewer words than a shingle has one shingle of all its words; a text without words has none."""
    data, offs = buffers(texts)
    h, doc, _, _ = hash_words(data, offs)
    w, inside = window_hashes(h, doc, width)
    d = doc[: len(w)][inside]
    w = w[inside]
    n = np.bincount(doc, minlength=len(offs) - 1)
    first = np.concatenate([[0], np.cumsum(n)])
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for size in range(1, width):
            at = short[n[short] == size]
            if len(at):
                x = np.full(len(at), size, np.uint64)
                for k in range(size):
                    x = mix(x * np.uint64(0x9E3779B97F4A7C15) + h[first[at] + k])
                extra[np.searchsorted(short, at)] = x
        w, d = np.concatenate([w, extra]), np.concatenate([d, short])
    order = np.lexsort((w, d))
    w, d = w[order], d[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (d[1:] != d[:-1])
    w, d = w[new], d[new]
    return w, np.concatenate([[0], np.cumsum(np.bincount(d, minlength=len(offs) - 1))])


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(77)
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1) | np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def prefixes(shingles: np.ndarray, bounds: np.ndarray, depth: int, trees: int) -> np.ndarray:
    """For each text (a row, with shingles) and each tree the hashes of its label's prefixes of depth and of depth + 1."""
    size = np.diff(bounds)
    rows = np.flatnonzero(size > 0)
    out = np.zeros((len(rows), 2, trees), np.uint64)
    odd, turn = _seeds(trees * (depth + 1))
    at = 0
    while at < len(rows):
        end = max(at + 1, int(np.searchsorted(bounds[rows + 1], bounds[rows[at]] + (1 << 15), side="right")))
        part = shingles[bounds[rows[at]] : bounds[rows[end - 1] + 1]]
        starts = bounds[rows[at:end]] - bounds[rows[at]]
        for t in range(trees):
            key = np.full(end - at, t + 1, np.uint64)
            for k in range(depth + 1):
                s = t * (depth + 1) + k
                low = np.minimum.reduceat((part ^ turn[s]) * odd[s], starts)
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + (low >> np.uint64(8)))
                if k >= depth - 1:
                    out[at:end, k - depth + 1, t] = key
        at = end
    return out


def _sketch(batches, width: int, depth: int, trees: int):
    for whole in batches:
        for lo in range(0, len(whole), 512):
            batch = whole.slice(lo, 512)
            w, bounds = shingle_sets(pa.chunked_array([batch.column(2)]), width)
            size = np.diff(bounds)
            full = np.flatnonzero(size > 0)
            keys = prefixes(w, bounds, depth, trees).astype(np.int64)
            mixed = np.add.reduceat(mix(w), bounds[full]) if len(full) else np.zeros(0, np.uint64)
            node = mix(mixed + size[full].astype(np.uint64)).astype(np.int64)
            at = np.full(len(batch), -1)
            at[full] = np.arange(len(full))
            where = np.maximum(at, 0)
            nodes = pa.array(node[where] if len(full) else np.zeros(len(batch), np.int64), mask=at < 0)
            ends = pa.array(np.concatenate([[0], np.cumsum((at >= 0) * trees)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(keys[:, i].ravel())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), nodes, pa.array(size), *lists], ["id", "rid", "node", "size", "keys", "longer"])


def _sets(batches, width: int):
    """Of each text its sorted shingle hashes as bytes."""
    for whole in batches:
        for lo in range(0, len(whole), 256):
            batch = whole.slice(lo, 256)
            w, bounds = shingle_sets(pa.chunked_array([batch.column(1)]), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), binary_array(w, bounds)], ["node", "shingles"])


def _common(rows: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """How many shingles each of rows shares with each of others (rows themselves, if none)."""
    both = rows + (others or [])
    flat = np.concatenate(both)
    owner = np.repeat(np.arange(len(both)), [len(x) for x in both])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    start = np.flatnonzero(new)
    many = np.diff(np.append(start, len(flat))) > 1
    column = np.cumsum(np.concatenate([[0], many]))[:-1][np.cumsum(new) - 1]
    keep = many[np.cumsum(new) - 1]
    owner, column = owner[keep], column[keep]
    n = len(rows)
    out = np.zeros((n, len(others) if others else n), np.float32)
    total = int(column[-1]) + 1 if len(column) else 0
    step = max(1, min(total, max(64, (1 << 22) // max(1, len(both)))))
    edges = np.searchsorted(column, np.arange(0, total + step, step))
    for a, b in zip(edges[:-1], edges[1:]):
        if a < b:
            m = np.zeros((len(both), step), np.float32)
            m[owner[a:b], column[a:b] - column[a] // step * step] = 1
            out += m[:n] @ (m[n:] if others else m).T
    return out


def similar(same: np.ndarray, rows: np.ndarray, others: np.ndarray, threshold: float) -> np.ndarray:
    """Where the Jaccard similarity is threshold at least, by how many shingles are shared and the sizes of both sides' sets.

    In 64 bits, because pairs right at the threshold count; the slack is above rounding and below one shingle for any size."""
    both = rows.astype(np.float64)[:, None] + others.astype(np.float64)[None, :]
    return same.astype(np.float64) * (1 + threshold) >= threshold * both - 1e-9 * both


def _met_before(slots: np.ndarray, p: np.ndarray, q: np.ndarray, tree: int) -> np.ndarray:
    """Which pairs of p and q share a run in an earlier tree; slots: each row's runs by tree, 0 where it has none."""
    out = np.zeros((len(p), len(q)), bool)
    for t in range(tree):
        a, b = slots[p, t], slots[q, t]
        if a.any() and b.any():
            out |= (a[:, None] == b[None, :]) & (a != 0)[:, None]
    return out


def _verify(key, rows: pa.Table, threshold: float) -> pa.Table:
    get = lambda c: rows.column(c).to_numpy()
    node, copies, run, tree, block, first, second = map(get, ("node", "copies", "run", "tree", "block", "first", "second"))
    slots = rows.column("slots").combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
    shingles = rows.column("shingles")
    order = np.lexsort((node, second, first, run))
    mark = np.stack([run, first, second])[:, order]
    cuts = np.concatenate([[0], np.flatnonzero((mark[:, 1:] != mark[:, :-1]).any(0)) + 1, [len(order)]])
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        at = order[a:b]
        sets = [np.frombuffer(shingles[int(i)].as_buffer(), np.uint64) for i in at]
        size, m = np.array([len(x) for x in sets], np.float64), copies[at]
        if first[at[0]] == second[at[0]]:
            p = q = np.arange(len(at))
        else:
            p, q = np.flatnonzero(block[at] == first[at[0]]), np.flatnonzero(block[at] == second[at[0]])
            if not len(p) or not len(q):
                continue
        new = ~_met_before(slots[at], p, q, int(tree[at[0]]))
        if p is q:
            np.fill_diagonal(new, False)
        if not new.any():
            continue
        same = _common(sets) if p is q else _common([sets[i] for i in p], [sets[i] for i in q])
        i, j = np.nonzero(similar(same, size[p], size[q], threshold) & new)
        i, j = p[i], q[j]
        links, texts = np.bincount(i, m[j], len(at)), np.bincount(i, minlength=len(at))
        if p is not q:
            links, texts = links + np.bincount(j, m[i], len(at)), texts + np.bincount(j, minlength=len(at))
        root = roots(len(at), i, j)
        some = np.flatnonzero(texts)
        out.append((node[at][some], links[some].astype(np.int64), texts[some].astype(np.int64), node[at][root[some]]))
    cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
    return pa.table(dict(zip(("node", "n_links", "n_texts", "root"), cols)))


def forest_runs(nodes: DataFrame, threshold: float, depth: int) -> DataFrame:
    """node, copies, size, tree, run, slots (its runs by tree, 0 for none) for each run that has pairs no earlier tree's run has.

    nodes has node, copies, size, keys and longer (hashes of the prefixes of depth and depth + 1 in each tree)."""
    places = nodes.select("node", F.posexplode(F.arrays_zip("keys", "longer")).alias("tree", "x")).select("node", "tree", F.col("x.keys").alias("key"), F.col("x.longer").alias("longer"))
    short = durable(places.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    met = durable(places.join(broadcast_if_small(short, short.count(), 16), "key"))
    rows = met.count()
    largest = Window.partitionBy("node").orderBy(F.desc("n"), "key")  # TREES rows at most
    asked = met.withColumn("keeps", F.row_number().over(largest) <= spare_trees(threshold, depth))
    kept = asked.groupBy("key").agg(F.min("keeps").alias("keeps"), F.count("*").alias("n"))
    runs = durable(spread_join(met.drop("n"), kept, "key", "node", rows).select("node", "tree", F.when(F.col("keeps"), F.col("longer")).otherwise(F.col("key")).alias("run")))
    discard(met, short)
    alone = runs.groupBy("run").agg(F.count("*").alias("n")).filter("n > 1")
    runs_met = durable(spread_join(runs, alone, "run", "node", rows))
    slots = runs_met.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("tree", "run"))).alias("of"))
    slots = slots.select("node", F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.coalesce(F.try_element_at("of", t), F.lit(0).cast("long"))).alias("slots"))
    members = durable(runs_met.join(slots, "node").join(nodes.select("node", "copies", "size"), "node"))
    same = [F.when((F.min(F.col("slots")[t]) == F.max(F.col("slots")[t])) & (F.min(F.col("slots")[t]) != 0), t) for t in range(TREES)]
    first = members.groupBy("run").agg(F.least(*same).alias("first"), F.min("tree").alias("at"), F.count("*").alias("n")).filter("first = at").select("run", "n")
    out = durable(spread_join(members, first, "run", "node", rows))
    discard(runs, runs_met, members)
    return out


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.8, block_texts: int = 1024) -> DataFrame:
    """Per row: id, class_id, n_links, n_texts, kept.

    Texts link if the Jaccard similarity of their sets of `width` consecutive words is threshold at least (words as
    they stand, between ASCII white space). class_id is the smallest id that links reach, n_links the number of
    other documents linked directly (copies included), n_texts the number of different shingle sets among them
    other than the own, kept whether the row's id is its class_id. A text of fewer words is one shingle; a null
    text or one without words links with nothing. A null id comes last and is kept only if its class has no other.
    Rows that repeat id and text count as one document. An empty table gives an empty result; other columns are
    not read. A pair right at the threshold is found with a probability of RECALL at least, others with more.
    """
    depth = prefix_depth(threshold)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("rid", F.xxhash64("id", "text"))
    sketch = base.select("id", "rid", "text").mapInArrow(lambda x: _sketch(x, width, depth, TREES), "id long, rid long, node long, size long, keys array<long>, longer array<long>")
    sketch = durable(sketch.dropDuplicates(["rid"]))
    nodes = sketch.filter("node is not null").groupBy("node").agg(
        F.min("id").alias("id"), F.min_by("rid", F.struct(F.col("id").isNull(), "id", "rid")).alias("rid"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("keys").alias("keys"), F.first("longer").alias("longer")
    )
    nodes = durable(nodes)
    members = forest_runs(nodes, threshold, depth)
    wanted = durable(members.select("node").distinct().join(nodes.select("node", "rid"), "node"))
    texts = base.select("rid", "text").join(broadcast_if_small(wanted, wanted.count(), 32), "rid").dropDuplicates(["node"])  # rows alike in id and text come more than once
    sets = durable(texts.select("node", "text").mapInArrow(lambda x: _sets(x, width), "node long, shingles binary"))
    sizes = members.groupBy("run").agg(F.count("*").alias("n"), F.greatest(F.ceil(F.count("*") / block_texts), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    dealt = spread_join(members, sizes, "run", "node", members.count()).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")}).drop("other")
    dealt = durable(dealt)
    copies, shingles = dealt.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    packs = max(1, shingles // PACK_SHINGLES)
    dealt = dealt.withColumn("pack", F.expr(f"if(blocks = 1, pmod(xxhash64(run), {packs}), xxhash64(run, first, second))")).drop("blocks", "size")
    tasks = min(MOST_TASKS, packs + members.sparkSession.sparkContext.defaultParallelism)
    joined = sets.join(broadcast_if_small(dealt, copies, 500), "node").repartition(tasks, "pack")  # work is not in proportion to bytes
    linked = durable(joined.groupBy("pack").applyInArrow(grouped(_verify, threshold=threshold), _FOUND))
    discard(members, wanted, sets)
    counts = linked.groupBy("node").agg(F.sum("n_links").alias("n_links"), F.sum("n_texts").alias("n_texts"))
    parts = components(linked, "node", "root")
    classes = nodes.select("node", "id", "copies").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = classes.groupBy("component").agg(F.min("id").alias("class_id"))
    result = classes.join(least, "component").join(counts, "node", "left")
    result = result.select("node", "class_id", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("n_texts", F.lit(0)).alias("n_texts"))
    rows = base.select("id", "rid").join(sketch.select("rid", "node"), "rid", "left").join(result, "node", "left")
    out = rows.select(F.col("id").alias(id_col), F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_texts"))
    return out.withColumn("kept", F.col("class_id").eqNullSafe(F.col(id_col)))
