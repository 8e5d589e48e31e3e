"""A training corpus from the documents table, in five stages that each work on all that the stage before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.bpe import bpe_round_trip
from wakeline.llm.common import broadcast_if_small, durable, table, tuned
from wakeline.llm.jaccard_join import jaccard_join
from wakeline.llm.line_dedup import line_dedup
from wakeline.llm.mixing import mix_sources
from wakeline.llm.queries import held_out, tokenizer_path
from wakeline.llm.toxicity import reject_toxic

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose toxicity score, learnt from the labelled rows that are not held out, is 0.3 or more."""
    labelled = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out(F.col("doc_id")))
    return reject_toxic(docs.select(*COLUMNS), labelled, threshold=0.3)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that repeat an earlier line up to one word; a document of which no line is left goes with them."""
    done = line_dedup(docs.select(*COLUMNS)).filter("lines_in > lines_removed or lines_in = 0")
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link by a Jaccard similarity of 0.8 or more on five words, the one with the smallest id stays."""
    tuned(spark)
    gone = durable(jaccard_join(docs.select("doc_id", "text")).filter("not kept").select("doc_id").distinct())
    return docs.select(*COLUMNS).join(broadcast_if_small(gone, gone.count(), 16), "doc_id", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document is taken once at least; those of rarer sources more often, twice as often as others at most."""
    mixed = mix_sources(docs.select(*COLUMNS), repeats=2.0, cover=True).filter("mix_copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document's whole text, and a digest of what they decode to."""
    tuned(spark)
    done = bpe_round_trip(docs.select("doc_id", "text"), tokenizer_path())
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix),
    ("bpe", encode),
]

#: SQL cannot express the toxicity model; tests/llm hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
