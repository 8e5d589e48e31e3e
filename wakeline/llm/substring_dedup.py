"""Removal of repeated passages, by anchors at the positions of a difference cover.

A passage of WINDOW words that starts at word i of one text and at word j of another shares, for some shift
k < period, a position i + k that is in the cover modulo the period while j + k is as well. So it is enough to
hash runs of WINDOW - period + 1 words at cover positions only. Runs that more than one document has are the
anchors; only windows that hold an anchor are extended to full windows, hashed, and given the smallest
document that they start in.

Windows are told apart by two hashes of 64 bits each over two such hashes of each word.

Nothing is paired: batches of documents send each hash once to the range of hashes it belongs to, and get back
the hashes that other batches have too. A passage in a third of all documents costs one entry a batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, batches_for, buffers, cogrouped, from_planes, grouped, hash_words, planes, window_hashes

#: A perfect difference cover: every residue modulo PERIOD is a difference of two of its members.
PERIOD, COVER = 7, (0, 1, 3)
_U48 = np.uint64((1 << 48) - 1)
_SENT = "part long, batch long, hashes binary, ids binary"


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().fill_null(LAST_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def _words(docs: pa.Table, wide: bool = False):
    data, offs = buffers(docs.column("text"))
    return data, *hash_words(data, offs, wide)


def _sorted(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of windows (a row of two hashes each), stable, and where in it each different window starts."""
    order = np.argsort(w[:, 0], kind="stable")
    x = w[order]
    new = np.ones(len(x), bool)
    new[1:] = x[1:, 0] != x[:-1, 0]
    if (~new[1:] & (x[1:, 1] != x[:-1, 1])).any():  # one hash is equal, the other is not
        order = np.lexsort((w[:, 1], w[:, 0]))
        x = w[order]
        new[1:] = (x[1:] != x[:-1]).any(1)
    return order, np.flatnonzero(new)


def _find(known: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of w its place in known (sorted windows, one at least), and whether it is there."""
    n = len(known)
    at = np.minimum(np.searchsorted(known[:, 0], w[:, 0]), n - 1)
    while True:
        after = np.minimum(at + 1, n - 1)
        step = (after > at) & (known[at, 0] == w[:, 0]) & (known[at, 1] != w[:, 1]) & (known[after, 0] == w[:, 0])
        if not step.any():
            return at, (known[at] == w).all(1)
        at[step] += 1


def _windows(h: np.ndarray, more: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    w, inside = window_hashes(h, doc, window)
    return np.stack([w, window_hashes(more, doc, window)[0]], axis=1), inside


def _anchors(h: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of anchors, and their hashes (47 bits, shifted left by one)."""
    w, inside = window_hashes(h, doc, window - PERIOD + 1)
    n = len(w)
    first = np.searchsorted(doc, doc[:n]) if n else np.zeros(0, np.int64)
    at = np.flatnonzero(inside & np.isin((np.arange(n) - first) % PERIOD, COVER))
    return at, (w[at] >> np.uint64(16)) & ~np.uint64(1) & _U48


def _cut(keys: np.ndarray, parts: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys lie in ranges, one a part: the parts that occur, and the bounds of each."""
    part = ((keys >> np.uint64(bits - 31)) * np.uint64(parts)) >> np.uint64(31)
    at = np.flatnonzero(np.diff(part)) + 1 if len(part) else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], at, [len(keys)]]) if len(keys) else np.zeros(1, np.int64)
    return part[bounds[:-1]].astype(np.int64), bounds.astype(np.int64)


def _six(x: np.ndarray) -> np.ndarray:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def _anchors_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    x, sizes = from_planes(column, 6)
    out = np.zeros((len(x), 8), np.uint8)
    out[:, :6] = x
    return out.view("<u8").ravel(), sizes


def _windows_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    x, sizes = from_planes(column, 16)
    return x.view(np.uint64), sizes


def _send(key: int, parts: np.ndarray, hashes: pa.Array, ids: pa.Array | None) -> pa.Table:
    n = len(parts)
    return pa.table({"part": pa.array(parts, pa.int64()), "batch": pa.array(np.full(n, key), pa.int64()), "hashes": hashes, "ids": pa.nulls(n, pa.binary()) if ids is None else ids})


def _send_anchors(key, docs: pa.Table, window: int, parts: int) -> pa.Table:
    ids = _ids(docs.column("id"))
    _, h, doc, _, _ = _words(docs)
    at, a = _anchors(h, doc, window)
    d = ids[doc[at]]
    order = np.argsort(a, kind="stable")
    a, d = a[order], d[order]
    new = np.concatenate([[True], a[1:] != a[:-1]]) if len(a) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    many = np.minimum.reduceat(d, start) != np.maximum.reduceat(d, start) if len(start) else np.zeros(0, bool)
    a = a[start]
    cut, bounds = _cut(a, parts, 48)
    return _send(key[0].as_py(), cut, planes(_six(a | many.astype(np.uint64)), bounds), None)


def _shared_anchors(key, sent: pa.Table) -> pa.Table:
    """For each batch, its anchors that another document has too."""
    x, sizes = _anchors_of(sent.column("hashes"))
    batch = np.repeat(sent.column("batch").to_numpy(), sizes)
    a = x >> np.uint64(1)
    order = np.argsort(a, kind="stable")
    a, many, batch = a[order], (x & np.uint64(1)).astype(bool)[order], batch[order]
    start = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
    if not len(start):
        return _send(0, np.zeros(0, np.int64), pa.array([], pa.binary()), None)
    size = np.diff(np.append(start, len(a)))
    shared = np.repeat((size > 1) | np.logical_or.reduceat(many, start), size)
    a, batch = a[shared], batch[shared]
    order = np.argsort(batch, kind="stable")
    return _by_batch(batch[order], _six(a[order] << np.uint64(1)))


def _by_batch(batch: np.ndarray, hashes: np.ndarray) -> pa.Table:
    at = np.flatnonzero(np.diff(batch)) + 1 if len(batch) else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], at, [len(batch)]]).astype(np.int64) if len(batch) else np.zeros(1, np.int64)
    n = len(bounds) - 1
    return pa.table({"part": pa.array(np.zeros(n), pa.int64()), "batch": pa.array(batch[bounds[:-1]], pa.int64()), "hashes": planes(hashes, bounds), "ids": pa.nulls(n, pa.binary())})


def _send_windows(key, docs: pa.Table, back: pa.Table, window: int, parts: int) -> pa.Table:
    """Windows that hold a shared anchor, each with the smallest document of the batch that has it."""
    shared = np.sort(_anchors_of(back.column("hashes"))[0])
    if not len(shared) or not len(docs):
        return _send(0, np.zeros(0, np.int64), pa.array([], pa.binary()), None)
    ids = _ids(docs.column("id"))
    _, h, doc, _, _, more = _words(docs, True)
    at, a = _anchors(h, doc, window)
    at = at[shared[np.minimum(np.searchsorted(shared, a), len(shared) - 1)] == a]
    w, inside = _windows(h, more, doc, window)
    near = np.zeros(len(h) + 1, np.int64)
    near[at + 1] = 1
    near = np.cumsum(near)
    n = len(w)
    take = np.flatnonzero(inside & (near[PERIOD : PERIOD + n] > near[:n]))
    w, d = w[take], ids[doc[take]]
    order, start = _sorted(w)
    w = w[order[start]]
    least = np.minimum.reduceat(d[order], start) if len(start) else d
    cut, bounds = _cut(w[:, 0], parts, 64)
    return _send(key[0].as_py(), cut, planes(w, bounds), planes(least, bounds))


def _first_documents(key, sent: pa.Table) -> pa.Table:
    """For each batch, its windows that start in a document of another batch that is smaller than all of its own with them."""
    w, sizes = _windows_of(sent.column("hashes"))
    d = from_planes(sent.column("ids"), 8)[0].view(np.int64).ravel()
    batch = np.repeat(sent.column("batch").to_numpy(), sizes)
    order, start = _sorted(w)
    w, d, batch = w[order], d[order], batch[order]
    if not len(start):
        return _by_batch(batch, w)
    least = np.repeat(np.minimum.reduceat(d, start), np.diff(np.append(start, len(w))))
    tell = least < d
    w, batch = w[tell], batch[tell]
    order = np.argsort(batch, kind="stable")
    return _by_batch(batch[order], w[order])


def _strip(key, docs: pa.Table, back: pa.Table, window: int) -> pa.Table:
    n_docs = len(docs)
    if not n_docs:
        return pa.table({"id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept": pa.array([], pa.string())})
    ids = _ids(docs.column("id"))
    data, h, doc, s, e, more = _words(docs, True)
    w, inside = _windows(h, more, doc, window)
    take = np.flatnonzero(inside)
    x, d = w[take], ids[doc[take]]
    order, start = _sorted(x)
    sx, sd = x[order], d[order]
    gone = np.zeros(len(h) + 1, np.int64)
    if len(start):
        least = np.minimum.reduceat(sd, start)
        far = _windows_of(back.column("hashes"))[0]
        if len(far):
            at, hit = _find(sx[start], far)
            least[at[hit]] = np.iinfo(np.int64).min
        size = np.diff(np.append(start, len(sx)))
        dup = take[order[sd > np.repeat(least, size)]]
        gone[dup] += 1
        gone[dup + window] -= 1
    removed = np.cumsum(gone[:-1]) > 0
    n_words = np.bincount(doc, minlength=n_docs)
    n_removed = np.bincount(doc[removed], minlength=n_docs)
    kept = ~removed
    raw, texts = data.tobytes(), []
    bounds = np.concatenate([[0], np.cumsum(n_words)])
    for i in range(n_docs):
        a, b = bounds[i], bounds[i + 1]
        if n_removed[i]:
            k = np.flatnonzero(kept[a:b]) + a
            texts.append(b" ".join([raw[p:q] for p, q in zip(s[k].tolist(), e[k].tolist())]))
        else:
            texts.append(b" ".join(raw[s[a] : e[b - 1]].split()) if b > a else b"")
    return pa.table({"id": docs.column("id"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(texts, pa.binary()).cast(pa.string())})


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """Per row: id, n_words, n_removed, kept (the words that stay, joined by one space).

    A word is any run of characters other than ASCII white space. A word goes if a window of `window` words
    covers it whose words also start in a document with a smaller id, as the input stands. A null text has no
    words; a null id comes after all other ids; rows of one id never remove each other's words; texts shorter
    than a window lose nothing. An empty table gives an empty result. Other columns are not read.
    """
    if window < PERIOD:
        raise ValueError(f"window must be {PERIOD} words at least")
    n = batches_for(docs, text_col)
    tasks = max(-(-n // 4), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # so that a task's share does not grow with the table
    parts = max(min(n, 4096), n // 16)  # ranges of hashes: as many as batches, or fewer where a batch would send few hashes to each
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    base = base.select(F.pmod(F.xxhash64("id", "text"), F.lit(n)).alias("batch"), "id", "text").repartition(tasks, "batch")
    texts = base.groupBy("batch")
    anchors = texts.applyInArrow(grouped(_send_anchors, window=window, parts=parts), _SENT)
    shared = anchors.repartition(tasks, "part").groupBy("part").applyInArrow(grouped(_shared_anchors), _SENT)
    windows = texts.cogroup(shared.repartition(tasks, "batch").groupBy("batch")).applyInArrow(cogrouped(_send_windows, window=window, parts=parts), _SENT)
    first = windows.repartition(tasks, "part").groupBy("part").applyInArrow(grouped(_first_documents), _SENT)
    return texts.cogroup(first.repartition(tasks, "batch").groupBy("batch")).applyInArrow(cogrouped(_strip, window=window), "id long, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col)
