import json
from dataclasses import replace
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline import config
from wakeline.config import PipelineConfig
from wakeline.operators import ingest
from wakeline.plans import pipeline
from wakeline.sources import ais, geojson, jdbc, wkb
from wakeline.sources.store import number
from wakeline.streaming import points as streaming

RAW = "mmsi long, lat double, lon double, sog double, timestamp timestamp_ntz, transponder_type string"


def reports(spark, day, n=40, mmsi=219000001, kind="class a", lat=57.05):
    start = int(datetime.fromisoformat(f"{day}T00:00:00+00:00").timestamp())
    rows = [(mmsi, lat, 10.0 + 0.002 * i, 10.0, start + 60 * i, kind) for i in range(n)]
    df = spark.createDataFrame(rows, "mmsi long, lat double, lon double, sog double, s long, transponder_type string")
    return df.withColumn("timestamp", F.timestamp_seconds("s").cast("timestamp_ntz")).select(*[x.split()[0] for x in RAW.split(", ")])


def test_file_names():
    assert ais.file_date("aisdk-2025-12-01.pq") == date(2025, 12, 1)
    assert ais.file_date("aisdk-2025-12-01.parquet") is None and ais.file_date("other-2025-12-01.pq") is None
    with pytest.raises(ValueError):
        ais.file_date("aisdk-2025-13-01.pq")


def test_pruning():
    files = [ais.DayFile(date(2025, 12, d), f"aisdk-2025-12-0{d}.pq", "") for d in (1, 2, 3, 4)]
    assert [f.day.day for f in ais.select(files, datetime(2025, 12, 1, 12), date(2025, 12, 2), date(2025, 12, 3))] == [2, 3]
    assert len(ais.select(files)) == 4 and ais.select(files, date(2025, 12, 4)) == []


def test_discovery(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    for name in ("aisdk-2025-12-02.pq", "deep/aisdk-2025-12-01.pq", "x.pq"):
        (tmp_path / name).write_text("")
    assert [f.name for f in ais.discover(spark, str(tmp_path))] == ["aisdk-2025-12-01.pq", "aisdk-2025-12-02.pq"]
    with pytest.raises(ValueError):
        ais.discover(spark, str(tmp_path / "none"))


def test_cleaning(spark):
    good = reports(spark, "2024-01-01", 12)
    again = good.limit(1).withColumn("sog", F.lit(3.0))
    few = reports(spark, "2024-01-01", 9, 219000002)
    first = reports(spark, "2024-01-01", 12, 919000003)
    other = reports(spark, "2024-01-01", 12, 219000004, "class b")
    mixed = reports(spark, "2024-01-01", 3, 219000001, "class b", 56.0)
    none = reports(spark, "2024-01-01", 3, 219000001, lat=91.0)
    null = good.limit(2).withColumn("lat", F.lit(None).cast("double"))
    out = ingest.clean_points(good.unionAll(again).unionAll(few).unionAll(first).unionAll(other).unionAll(mixed).unionAll(none).unionAll(null))
    rows = out.collect()
    assert len(rows) == 15 and {r.mmsi for r in rows} == {219000001}
    assert sorted(r.sog for r in rows)[0] == 3.0
    assert ingest.unseen_points(out, out.filter("lat > 57")).count() == 3
    assert ingest.clean_points(good.limit(0)).count() == 0


def test_high_water_mark_of_nothing(spark):
    none = spark.createDataFrame([], "ts_end timestamp_ntz")
    assert ingest.high_water_mark(none, none).first()[0] == datetime(1970, 1, 1)


def test_whole_run_is_incremental(spark, tmp_path):
    folder = tmp_path / "ais"
    folder.mkdir()
    write = lambda day, **kw: reports(spark, day, **kw).coalesce(1).write.parquet(str(folder / f"aisdk-{day}.pq"))
    write("2024-01-01")
    write("2024-01-02")
    cfg = PipelineConfig(ais_path=str(folder), schema="run_base", cs_schema="run_cells", end=date(2024, 1, 1))
    assert pipeline.run_pipeline(spark, cfg) == {"points": {"files": 1, "rows": 40}, "construct": {"trajectory_ls": 1, "stop_poly": 0}}
    store = pipeline.store_of(spark, cfg)
    first = store.read("trajectory_cs").count()
    assert first > 100 and store.read("points_ingestion_log").count() == 1
    cfg = PipelineConfig(ais_path=str(folder), schema="run_base", cs_schema="run_cells")
    assert pipeline.run_pipeline(spark, cfg)["points"] == {"files": 1, "rows": 40}
    assert sorted(r.trajectory_id for r in store.read("trajectory_ls").collect()) == [1, 2]
    assert pipeline.run_pipeline(spark, cfg) == {"points": {"files": 0, "rows": 0}, "construct": {"trajectory_ls": 0, "stop_poly": 0}}
    visits = store.read("trajectory_cs")
    assert visits.select("trajectory_id").distinct().count() == 2 and visits.filter("ts_exit < ts_entry").count() == 0
    box = geojson.regions(spark, [(7, "box", [[[(10.0, 57.04), (10.02, 57.04), (10.02, 57.06), (10.0, 57.06)]]])])
    pipeline.convert_regions(spark, replace(cfg, skip_z21=True), box)
    assert store.read("region_cs").count() == 0 and store.read("region_cs_z13").count() > 0
    pipeline.convert_regions(spark, cfg, box)
    pipeline.convert_regions(spark, cfg, box)
    coarse = {z: {r[0] for r in store.read("region_cs").selectExpr(f"shiftright(cell_z21, {2 * (21 - z)})").distinct().collect()} for z in (13, 17)}
    for z, expected in coarse.items():
        found = [r[0] for r in store.read(f"region_cs_z{z}").select(f"cell_z{z}").collect()]
        assert len(found) == len(set(found)) and set(found) == expected
    pipeline.convert_passages(spark, cfg)
    assert [store.read(t).select("passage_id").distinct().count() for t in ("passage_cs_z13", "passage_cs_z17")] == [12, 12]
    assert store.read("region_poly").count() == 1 and store.read("passage_cs").select("passage_id").distinct().count() == 12
    from wakeline.operators.cells import crossings

    assert crossings(visits, store.read("region_cs"), "trajectory_id", "region_id").count() == 2
    store.drop(cells=True)
    assert not store.exists("trajectory_cs") and store.exists("points")
    with pytest.raises(ValueError, match="namespaces"):
        store.read("trajectory_cs")
    store.drop(lines=True)
    assert not store.exists("points_ingestion_log")


def test_rows_that_fail_a_check_are_not_stored(spark):
    from wakeline.sources.store import Store

    store = Store(spark, "checked", "checked")
    store.create_namespaces()
    store.create()
    row = spark.createDataFrame([(1, 2, datetime(2024, 1, 2), datetime(2024, 1, 1), [])], "trajectory_id int, mmsi long, ts_start timestamp_ntz, ts_end timestamp_ntz, coords array<struct<lon:double,lat:double,ts:double>>")
    with pytest.raises(Exception, match="does not meet"):
        store.append("trajectory_ls", row)
    assert store.read("trajectory_ls").count() == 0
    store.drop(True, True)


def test_numbers_are_dense_and_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    rows = number(df, "n", ["v"], after=10).orderBy("v").collect()
    assert [r.n for r in rows] == list(range(11, 1011))
    assert number(df.limit(0), "n", ["v"]).count() == 0


def test_streams(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    for day in ("2024-01-01", "2024-01-02"):
        reports(spark, day).coalesce(1).write.parquet(str(tmp_path / day))
        next((tmp_path / day).glob("part-*")).rename(folder / f"aisdk-{day}.pq")
    load = lambda n: streaming.load_stream(streaming.report_stream(spark, str(folder)), out, str(tmp_path / f"check{n}")).awaitTermination()
    load(1)
    assert spark.read.parquet(out).count() == 80
    load(2)  # the files once more: no point is added
    assert spark.read.parquet(out).count() == 80
    for name, made in (("activity", streaming.vessel_activity), ("sessions", streaming.vessel_sessions), ("distinct", streaming.distinct_reports)):
        stream = made(streaming.report_stream(spark, str(folder), 10))
        mode = "append" if name == "distinct" else "complete" if name == "activity" else "append"
        q = stream.writeStream.format("memory").queryName(f"s_{name}").outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.table(f"s_{name}").count() > 0


def test_geojson(tmp_path, spark):
    polygon = {"type": "Polygon", "coordinates": [[[1, 2], [3, 4], [5, 6], [1, 2]]]}
    feature = {"type": "Feature", "geometry": polygon}
    assert geojson.parse_region(json.dumps(feature)) == geojson.parse_region(json.dumps({"type": "FeatureCollection", "features": [feature, {}]}))
    multi = {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [polygon["coordinates"]] * 2}}
    assert len(geojson.parse_region(json.dumps(multi))) == 2
    for bad in (polygon, {"type": "FeatureCollection", "features": []}, {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}}, []):
        with pytest.raises(ValueError):
            geojson.parse_region(json.dumps(bad))
    (tmp_path / "r.geojson").write_text(json.dumps(multi, indent=1))
    assert len(geojson.read_region(spark, str(tmp_path / "r.geojson"))) == 2


def test_wkb(spark):
    kind, rows = wkb.decode(wkb.line_m([1.0, 2.0], [3.0, 4.0], [5.9, 7.0]))
    assert kind == "line" and rows.tolist() == [[1, 3, 5], [2, 4, 7]]
    kind, rings = wkb.decode(wkb.polygon([[(0, 0), (1, 0), (1, 1), (0, 0)]]))
    assert kind == "polygon" and np.array(rings).shape == (1, 4, 2)
    df = spark.createDataFrame([(1, [{"lon": 1.0, "lat": 2.0, "ts": 3.5}, {"lon": 4.0, "lat": 5.0, "ts": 6.0}])], "id int, coords array<struct<lon:double,lat:double,ts:double>>")
    assert wkb.decode(bytes(wkb.with_wkb(df, "coords").first().geom_wkb))[1].tolist() == [[1, 2, 3], [4, 5, 6]]


def test_jdbc_without_a_driver_says_so(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc.read(spark, "jdbc:postgresql://localhost/none", "points")


def test_settings():
    assert config.parse_bool(None) is None and config.parse_bool(" YES ") and not config.parse_bool("0")
    with pytest.raises(ValueError):
        config.parse_bool("maybe", "ETL_DROP")
    assert config.answer("", True) and not config.answer("n", True) and config.answer("what", True)
    for text in ("2024-02-01", "2024/02/01", "01-02-2024", "01/02/2024"):
        assert config.parse_date(text) == date(2024, 2, 1)
    for text in ("2024", "1-2-3", "2024-13-01"):
        with pytest.raises(ValueError):
            config.parse_date(text)
    both = (date(2024, 1, 1), date(2024, 1, 5))
    assert config.parse_date_range("2024-01-01 - 2024-01-05") == config.parse_date_range("01/01/2024 to 05/01/2024") == config.parse_date_range("2024-01-01, 2024-01-05") == both
    assert config.parse_date_range("") == (None, None)
    with pytest.raises(ValueError):
        config.parse_date_range("2024-01-05 to 2024-01-01")
    env = {"DUCKDB_SCHEMA": "base", "AIS_DATA_PATH": "/data", "DUCKDB_CS_SCHEMA": "cells", "ETL_DROP": "yes", "ETL_DROP_CS": "no", "AIS_START_DATE": "2024-01-01"}
    c = PipelineConfig.from_env(env)
    assert (c.lines, c.cells, c.drop_ls, c.drop_cs, c.start, c.transform) == ("base", "cells", True, False, date(2024, 1, 1), True)
    for bad in ({"AIS_DATA_PATH": "/data"}, env | {"DB_BACKEND": "other", "OTHER_SCHEMA": "x"}, env | {"AIS_END_DATE": "2023-01-01"}):
        with pytest.raises(ValueError):
            PipelineConfig.from_env(bad)
    said = iter(["", "nonsense", "2024-01-01 to 2024-01-05"])
    told = []
    assert config.ask_step({}, "ETL_DROP", "Drop?", default=False, ask=lambda _: next(said)) is False
    assert config.ask_step({"ETL_DROP": "y"}, "ETL_DROP_LS", "Drop?", "ETL_DROP", False) is True
    assert config.ask_period("Period", available=both, ask=lambda _: next(said), tell=told.append) == both and len(told) == 2
    assert config.ask_period("Period", *both, ask=lambda _: "") == both
    assert config.format_eta(3725.9) == "01:02:05"
