"""The registered queries of the training-data operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .bpe import bpe_round_trip
from .common import table
from .embedding_dedup import embedding_dedup
from .html_extract import html_extract
from .jaccard_join import jaccard_join
from .line_dedup import line_dedup
from .mixing import mix_sources
from .secrets import PATTERNS, find_secrets
from .substring_dedup import substring_dedup
from .topk_search import topk_search
from .toxicity import toxicity

#: A source is taken so many times at most.
MIX_REPEATS = 1.5


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", F.col("lines_in").alias("n_lines"), F.col("lines_removed").alias("n_removed"), "text")


def held_out(doc_id) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out(F.col("doc_id")))
    scored = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), labelled)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "evidence")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    done = mix_sources(docs, repeats=MIX_REPEATS)
    return done.select("doc_id", "source", *[F.col(f"mix_{x}").alias(x) for x in ("tokens", "block", "weight", "passes", "copies")])


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer_path())
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = html_extract(table(spark, sf_dir, "pages"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "slot")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = find_secrets(table(spark, sf_dir, "documents"))
    written = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as long)").alias(f"n_{k}") for k in PATTERNS]
    return done.select("doc_id", *counts, F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"))


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and v: floor(64 * x) of each component, as a double; null for components that are not finite, for topk_search to leave out."""
    whole = "if(abs(x) < 1e13, double(floor(64 * double(x))), 64 * double(x))"  # from there on all doubles are whole
    return vectors.select("vec_id", F.expr(f"transform(embedding, x -> if(isnan(x) or abs(x) = double('infinity'), null, {whole}))").alias("v"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk_search(integer_vectors(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 20 == 0, k=20)
    return found.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_bpe": op4_bpe,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_html_extract": op6_html_extract,
    "op7_secrets": op7_secrets,
    "op8_topk": op8_topk,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_jaccard_join": op10_jaccard_join,
}

#: The other queries (2, 4, 6, 7) have brute-force tests: SQL has no such model, tokenizer, parser or test battery.
SQL = {
    "op1_line_dedup": oracles.OP1,
    "op3_mixing": oracles.op3(MIX_REPEATS),
    "op5_embedding_dedup": oracles.OP5,
    "op8_topk": oracles.OP8,
    "op9_substring_dedup": oracles.OP9,
    "op10_jaccard_join": oracles.OP10,
}
