"""Each stage of the pipeline on its own input against its brute-force version."""

import hashlib
import os

import corpus_pipeline as cp
import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wakeline.llm import queries
from wakeline.llm.common import durable

from .test_scores import mixed
from .test_texts import jaccard_classes, kept_lines


@pytest.fixture(scope="module")
def steps(spark, sf):
    docs = [cp.table(spark, sf, "documents")]
    for _, stage in cp.STAGES:
        docs.append(durable(stage(spark, docs[-1], sf)))
    return docs


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_stages_keep_the_columns_of_documents(steps):
    assert 4 <= len(cp.STAGES) <= 5
    for df in steps[:-1]:
        assert sorted(df.columns) == sorted(cp.COLUMNS)


def test_toxicity_goes_by_the_score(spark, sf, steps):
    score = {r.doc_id: r.score for r in queries.op2_toxicity(spark, sf).collect()}
    assert sorted(rows(steps[1], "doc_id")) == sorted((i,) for i, s in score.items() if s < 0.3)


def test_lines(steps):
    want = kept_lines(rows(steps[1], "doc_id", "text"))
    before = dict(rows(steps[1], "doc_id", "text"))
    want = {i: t for i, t in want.items() if t.strip() or not before[i].strip()}
    assert dict(rows(steps[2], "doc_id", "text")) == want
    assert all(n == len(t) for t, n in rows(steps[2], "text", "n_chars"))


def test_near_copies(spark, steps, sf):
    for docs in (steps[2], steps[0]):
        classes = jaccard_classes(rows(docs, "doc_id", "text"))
        assert sorted(rows(cp.drop_near_copies(spark, docs, sf), "doc_id")) == sorted((i,) for i, c in classes.items() if c[3])


def test_mixture(steps):
    want, _ = mixed(rows(steps[3], "doc_id", "text", "source"), 2.0, True)
    assert {r.doc_id: r.n for r in steps[4].groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == want
    assert min(want.values()) >= 1 and max(want.values()) <= 3


def test_tokens(steps):
    t = Tokenizer.from_file(queries.tokenizer_path())
    texts = dict(rows(steps[4], "doc_id", "text"))
    for i, n, ids, digest in rows(steps[5], "doc_id", "n_tokens", "ids", "decoded_sha256"):
        assert ids == t.encode(texts[i], add_special_tokens=False).ids and n == len(ids)
        assert digest == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_run_is_its_stages(spark, sf, steps):
    assert sorted(rows(cp.run(spark, sf), "doc_id", "decoded_sha256")) == sorted(rows(steps[5], "doc_id", "decoded_sha256"))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(name, spark, sf):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        path = f"{sf}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    df = queries.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    found = con.execute(queries.SQL[name])
    at = [[d[0] for d in found.description].index(c) for c in columns]
    assert sorted(str(list(r)) for r in df.select(*columns).collect()) == sorted(str([r[i] for i in at]) for r in found.fetchall())
