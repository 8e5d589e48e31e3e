"""Each registered query against its SQL in DuckDB, at the smallest size."""

import math
import os

import duckdb
import pytest

from wakeline.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path}/*.parquet')" if os.path.isdir(path) else f"create view {t} as select * from read_parquet('{path}')")
    return con


def tidy(v):
    return round(v, 6) if isinstance(v, float) and math.isfinite(v) else v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(name, spark, db, sf):
    df = catalogue.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(str([tidy(v) for v in r]) for r in df.select(*columns).collect())
    if name in catalogue.SQL:
        found = db.execute(catalogue.SQL[name])
        at = [[d[0] for d in found.description].index(c) for c in columns]
        assert got == sorted(str([tidy(r[i]) for i in at]) for r in found.fetchall())


def test_numbers_of_objects(spark, sf):
    """Trajectories, stops and cells at the smallest size."""
    assert catalogue.QUERIES["trajectories"](spark, sf).count() == 20
    assert catalogue.QUERIES["stops"](spark, sf).count() == 23
    assert catalogue.QUERIES["trajectory_cells"](spark, sf).count() == 7010
