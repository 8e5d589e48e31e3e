"""Helpers that the training-data operators share: table access, durable cuts of the lineage, size checks,
and vectorised hashing of the words of many texts at once."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows with no id come after all others wherever ids are compared.
LAST_ID = (1 << 63) - 1


#: Rows that go to Python at a time; Spark's 10,000 are tens of megabytes of text on either side of the pipe.
ARROW_ROWS = 1000


def tuned(spark: SparkSession) -> SparkSession:
    """The session, set for rows that hold whole texts, and to remove each job's shuffle files when it ends."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset, a temporary one on a local master, which has
    one machine; on a cluster each executor would write to a disk of its own, so there it is an error."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="wakeline-shared-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(sc._jsc.hadoopConfiguration()), at


def durable(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: a cut of the lineage that outlives lost executors.

    The table goes with discard(), at the latest when the driver ends."""
    spark = tuned(df.sparkSession)
    path = f"{shared_dir(spark)}/wakeline-{uuid.uuid4().hex}"
    files, at = _file_system(spark, path)
    df.write.parquet(path)
    files.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def discard(*staged: DataFrame) -> None:
    """Delete tables that durable() wrote and that nothing will read again."""
    for df in staged:
        files, at = _file_system(df.sparkSession, df._staged)
        files.delete(at, True)


def clear_of(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with its columns named by their places, so that no name can clash with an operator's own, and these names."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int, limit_mb: int = 32) -> DataFrame:
    """Hint a broadcast only where the counted rows prove that it stays below limit_mb; else Spark shuffles."""
    return F.broadcast(df) if rows * row_bytes <= limit_mb << 20 else df


def text_bytes(df: DataFrame, text_col: str) -> int:
    return df.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0


def batches_for(df: DataFrame, text_col: str, batch_mb: int = 8) -> int:
    """How many batches of about batch_mb the texts make; at least one for each shuffle partition."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-text_bytes(df, text_col) // (batch_mb << 20)))


def running(values: str, op, block: int = 64) -> str:
    """SQL for the running totals of an array under op, which is associative and takes and gives SQL. Blocks keep the work for n
    values near n * block + (n / block)**2 / 2, where one fold that appends to its result would copy n**2 / 2."""
    fold = lambda v: f"transform(array({v}), _s -> aggregate(slice(_s, 2, size(_s)), slice(_s, 1, 1), (_a, _x) -> concat(_a, array({op('element_at(_a, -1)', '_x')}))))[0]"
    parts = f"transform(sequence(0, (size(_v) - 1) div {block}), _k -> {fold(f'slice(_v, _k * {block} + 1, {block})')})"
    tops = fold("transform(_p, _y -> try_element_at(_y, -1))")
    joined = f"flatten(transform(_p, (_y, _k) -> if(_k = 0, _y, transform(_y, _z -> {op('_t[_k - 1]', '_z')}))))"
    return f"transform(array({values}), _v -> transform(array({parts}), _p -> transform(array({tops}), _t -> {joined})[0])[0])[0]"


# ---- hashing of words -------------------------------------------------------------------------------------------

_CHUNK = 1 << 18
_WBASE = 0xD1342543DE82EF95 | 1
_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse, self.n = base, pow(base, -1, 1 << 64), 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * self.n, 1024)
            self.p, self.q = _powers(self.base, self.n), _powers(self.inverse, self.n)
        return self.p[:n], self.q[:n]


_WORDS = _Powers(_WBASE)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and the offsets of each; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def hash_words(data: np.ndarray, offs: np.ndarray, wide: bool = False) -> tuple[np.ndarray, ...]:
    """For each maximal run of bytes other than ASCII white space, within one text: hash, text index, start, end, and with
    wide a second hash.

    A hash is a mixed sum over a word's bytes of a value for (byte, place in the word) that no linear form yields, so words
    cannot be built to cancel out. Memory beyond the results is bounded by a chunk (a single longer word aside)."""
    n = len(data)
    border = np.zeros(n + 1, bool)
    border[offs] = True
    got: list[tuple[np.ndarray, ...]] = []
    pos = 0
    while pos < n:
        size = _CHUNK
        while True:
            end = min(pos + size, n)
            if end == n or border[end] or _SEP[data[end]]:
                break
            cut = np.flatnonzero(_SEP[data[pos:end]] | border[pos:end])
            if len(cut) and cut[-1] > 0:
                end = pos + int(cut[-1])
                break
            size *= 2
        b = data[pos:end]
        sep, edge = _SEP[b], border[pos + 1 : end]
        word = ~sep
        first, last = word.copy(), word.copy()
        first[1:] &= sep[:-1] | edge
        last[:-1] &= sep[1:] | edge
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        if len(s):
            length = e - s
            starts = np.cumsum(length) - length
            place = np.arange(int(length.sum())) - np.repeat(starts, length)
            x = mix((place.astype(np.uint64) << np.uint64(8) | b[word]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x2545F4914F6CDD1D))
            h = [mix(np.add.reduceat(x, starts) + length.astype(np.uint64))]
            if wide:
                x ^= x >> np.uint64(29)
                x *= np.uint64(0xFF51AFD7ED558CCD)
                x ^= x >> np.uint64(32)
                h.append(mix(np.add.reduceat(x, starts) ^ length.astype(np.uint64)))
            got.append((h[0], s + pos, e + pos, *h[1:]))
        pos = end
    if not got:
        empty, none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return (none, empty, empty, empty, none) if wide else (none, empty, empty, empty)
    h, s, e, *more = (np.concatenate(x) for x in zip(*got))
    return h, np.searchsorted(offs, s, side="right") - 1, s, e, *more


def window_hashes(words: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of width consecutive words, and whether it lies within one text; one a starting word."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    p, q = _WORDS.upto(len(words))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * p, out=total[1:])
    return mix((total[width:] - total[:n]) * q[:n] + np.uint64(width)), doc[:n] == doc[width - 1 :]


def binary_array(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary array whose i-th item holds the bytes of values[bounds[i]:bounds[i + 1]]."""
    width = values.dtype.itemsize * int(np.prod(values.shape[1:], dtype=np.int64))
    offsets = pa.py_buffer((bounds * width).astype(np.int64).tobytes())
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offsets, data]).cast(pa.binary())


def planes(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary array whose i-th item holds values[bounds[i]:bounds[i + 1]], first the first bytes of all its values, then the second
    ones and so on: bytes that hardly change, as those of sorted hashes and of small ids, then lie together and compress well."""
    width = values.dtype.itemsize * int(np.prod(values.shape[1:], dtype=np.int64))
    rows = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), width)
    return pa.array([rows[a:b].T.tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())


def from_planes(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a column that planes() made, one row a value, and the number of values of each item."""
    parts = [np.frombuffer(x.as_buffer(), np.uint8).reshape(width, -1) for c in column.chunks for x in c]
    sizes = np.array([x.shape[1] for x in parts], np.int64)
    out, at = np.empty((int(sizes.sum()), width), np.uint8), 0
    for x in parts:
        out[at : at + x.shape[1]] = x.T
        at += x.shape[1]
    return out, sizes


def grouped(f, **kw):
    """f(key, rows, **kw) as applyInArrow takes it for a group."""
    return lambda key, rows: f(key, rows, **kw)


def cogrouped(f, **kw):
    """f(key, rows, others, **kw) as applyInArrow takes it for a pair of groups."""
    return lambda key, rows, others: f(key, rows, others, **kw)
