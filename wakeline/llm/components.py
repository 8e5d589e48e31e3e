"""Connected components of a link table, by alternating large-star and small-star rounds (all in DataFrames).

Each round hangs every node on the smallest node it knows of; rounds double what is known. No step holds the neighbours
of a node in one place: minima are pre-aggregated, and where a node has more than HOT neighbours, these are dealt to parts
that each meet a copy of the node's minimum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, discard, durable

#: Rows of one key that a join may bring together.
HOT = 512


def spread_join(many: DataFrame, one: DataFrame, key: str, salt: str, rows: int) -> DataFrame:
    """many joined with one on key; one has a row a key, and n, the number of rows that many has of it at most; many has a column
    salt that tells rows of one key apart, and no more than so many rows. Keys of more than HOT rows are dealt to parts."""
    parts = F.ceil(F.col("n") / HOT).cast("int")
    hot = one.filter(F.col("n") > HOT).select(key, parts.alias("__parts"))
    dealt = many.join(broadcast_if_small(hot, rows // HOT, 16), key, "left").withColumn("__part", F.coalesce(F.pmod(F.xxhash64(salt), F.col("__parts")).cast("int"), F.lit(0))).drop("__parts")
    copies = one.withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("n")
    return dealt.join(copies, [key, "__part"]).drop("__part")


def _stars(edges: DataFrame, rows: int) -> DataFrame:
    """One large-star and one small-star step over edges (u > v)."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    large = spread_join(both.filter("v > u"), least, "u", "v", 2 * rows).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    hung = spread_join(large, least, "u", "v", 2 * rows).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and component (the smallest node that links reach) of every node that has a link to another node."""
    u, v = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    edges = durable(links.select(u.alias("u"), v.alias("v")).filter("u <> v").distinct())
    print_of = lambda df: df.agg(F.count("*"), F.coalesce(F.sum(F.shiftright(F.xxhash64("u", "v"), 24)), F.lit(0))).first()[:]
    before = print_of(edges)
    while True:
        old, edges = edges, durable(_stars(edges, before[0]))
        discard(old)
        now = print_of(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
