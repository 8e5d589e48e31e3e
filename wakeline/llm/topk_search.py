"""Exact top-k search by inner product, with segment statistics as bounds at several resolutions.

Each vector is cut in segments; a segment keeps its mean and deviation. For two vectors the squared distance is
at least the sum over segments of size * ((mean - mean')^2 + (dev - dev')^2). With the stored lengths this lower
bound of the distance is an upper bound of the inner product. Pairs are bounded with few segments, what is left
with more, and only survivors get their exact distance (and with it their score).

Queries and candidates are dealt to blocks; each pair of blocks is a task that returns k rows a query at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, grouped

#: Segments a vector is cut in, coarse to fine.
LEVELS = (4, 16, 32)
MOST_TASKS = 50_000


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, each times the root of the segment's size."""
    d = x.shape[1]
    cuts = np.unique(np.linspace(0, d, min(segments, d) + 1).astype(int))
    size = np.diff(cuts)
    total = np.add.reduceat(x, cuts[:-1], axis=1)
    square = np.add.reduceat(x * x, cuts[:-1], axis=1)
    mean = total / size
    dev = np.sqrt((square / size - mean * mean).clip(0))
    return np.concatenate([mean, dev], axis=1) * np.sqrt(np.concatenate([size, size]))


def _best(k: int, who, score, ids):
    """The k best (score, then smaller id) of each query."""
    order = np.lexsort((ids, -score, who))
    who, score, ids = who[order], score[order], ids[order]
    rank = np.arange(len(who)) - np.searchsorted(who, who)
    keep = rank < k
    return who[keep], score[keep], ids[keep]


def search_block(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int):
    """Exact top k of the candidates for each query: indices of queries, scores, candidates' ids.

    The lower bound of a squared distance, |q|^2 + |c|^2 - 2 * <statistics>, is compared with the distance that a
    score at the query's limit has; both lengths cancel, so what is compared is <statistics> with the limit."""
    stats = [(statistics(q, s), statistics(c, s)) for s in LEVELS]
    slack = 1e-9 * (1 + np.sqrt((q * q).sum(1).max(initial=0) * (c * c).sum(1).max(initial=0)))
    who, score, ids = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
    m = min(4 * k, len(c))
    for at in range(0, len(q), 256):
        part = slice(at, at + 256)
        upper = stats[0][0][part] @ stats[0][1].T
        top = np.argpartition(-upper, m - 1, axis=1)[:, :m]  # the most promising set the limits
        first = np.empty(top.shape)
        for i in range(len(top)):
            first[i] = c[top[i]] @ q[at + i]
        first[c_ids[top] == q_ids[part, None]] = -np.inf
        limit = np.partition(first, -k, axis=1)[:, -k] - slack if m >= k else np.full(len(top), -np.inf)
        open_ = upper >= limit[:, None]
        for sq, sc in stats[1:]:
            columns = np.flatnonzero(open_.any(0))
            if 20 * np.count_nonzero(open_) < open_.size:
                break
            open_[:, columns] &= sq[part] @ sc[columns].T >= limit[:, None]
        if 20 * np.count_nonzero(open_) >= open_.size:  # many survivors: their distances in one product
            columns = np.flatnonzero(open_.any(0))
            exact = q[part] @ c[columns].T
            i, j = np.nonzero(open_[:, columns] & (exact >= limit[:, None]))
            exact, j = exact[i, j], columns[j]
        else:
            i, j = np.nonzero(open_)
            pieces = [np.einsum("ij,ij->i", q[at + i[a : a + 65536]], c[j[a : a + 65536]]) for a in range(0, len(i), 65536)]
            exact = np.concatenate([np.zeros(0), *pieces])
        keep = (exact >= limit[i]) & (q_ids[at + i] != c_ids[j])
        who.append(i[keep] + at)
        score.append(exact[keep])
        ids.append(c_ids[j[keep]])
    return _best(k, np.concatenate(who), np.concatenate(score), np.concatenate(ids))


def _search(key, rows: pa.Table, k: int) -> pa.Table:
    d = key[0].as_py()
    x = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), d)
    ids, query = rows.column("vec_id").to_numpy(), rows.column("query").to_numpy(zero_copy_only=False).astype(bool)
    q_ids = ids[query]
    none = np.zeros(0, np.int64)
    who, score, found = search_block(x[query], q_ids, x[~query], ids[~query], k) if query.any() and not query.all() else (none, none, none)
    return pa.table({"query_id": pa.array(q_ids[who], pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(score, pa.float64())})


def topk_search(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "v", query_rows: int = 1024, candidate_rows: int = 8192) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row that the column is_query marks, the k rows of other ids
    (all, if fewer) with the highest inner product in double precision, ties to the smaller id.

    Vectors that are null, empty, or hold null or non-finite components, and rows with no id, take no part; only
    vectors of one dimension are compared. Of rows that repeat an id the least vector counts. An empty table, or
    one row alone, gives an empty result. Other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter("vec_id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    rows = durable(rows.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("d", F.size("v")).withColumn("asked", is_query))
    counts = rows.groupBy("d").agg(F.ceil(F.count("*") / candidate_rows).cast("int").alias("n_c"), F.greatest(F.lit(1), F.ceil(F.count_if("asked") / query_rows)).cast("int").alias("n_q"))
    dealt = rows.join(counts, "d")
    hashed = F.xxhash64("vec_id")
    candidates = dealt.select("d", F.explode(F.sequence(F.lit(0), F.col("n_q") - 1)).alias("qb"), F.pmod(hashed, "n_c").cast("int").alias("cb"), "vec_id", "v", F.lit(False).alias("query"))
    queries = dealt.filter("asked").select("d", F.pmod(hashed, "n_q").cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), F.col("n_c") - 1)).alias("cb"), "vec_id", "v", F.lit(True).alias("query"))
    tasks = counts.agg(F.sum(F.col("n_c").cast("long") * F.col("n_q"))).first()[0] or 1
    both = candidates.unionAll(queries).repartition(min(2 * tasks, MOST_TASKS), "d", "qb", "cb")  # work is not in proportion to bytes
    found = both.groupBy("d", "qb", "cb").applyInArrow(grouped(_search, k=k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

