"""The whole run: ingest daily files, construct trajectories and stops, transform them to cells; each step incremental."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.config import PipelineConfig
from wakeline.operators import cells, ingest, segment
from wakeline.sources import ais, reference
from wakeline.sources.store import Store, number, staged


def store_of(spark: SparkSession, config: PipelineConfig) -> Store:
    return Store(spark, config.lines, config.cells)


def load_points(spark: SparkSession, config: PipelineConfig) -> dict[str, int]:
    """Files newer than the watermark and within the period go into points, new keys only; the log tells of each file."""
    store = store_of(spark, config)
    store.require("points")
    files = ais.discover(spark, config.ais_path)
    if not files:
        return {"files": 0, "rows": 0}
    mark = ais.watermark(store.read("points_ingestion_log"), store.read("points")).first()[0]
    files = ais.select(files, mark, config.start, config.end)
    if not files:
        return {"files": 0, "rows": 0}
    raw = ais.read(spark, files)
    named = spark.createDataFrame([(f.name, f.path, f.day) for f in files], "file_name string, file_path string, file_date date")
    entries = staged(ais.log_entries(raw, named, F.localtimestamp()))
    first, last = entries.agg(F.to_date(F.min("min_ts")), F.to_date(F.max("max_ts"))).first()
    known = store.read("points").filter(F.col("point_day").between(F.lit(first), F.lit(last)))  # prunes the days that cannot hold repeats
    points = ingest.clean_points(raw, config.thresholds.vessel_points, only_mmsi=config.only_mmsi)
    fresh = staged(ingest.unseen_points(points, known))
    store.append("points", fresh)
    store.replace("points_ingestion_log", ais.merge_log(store.read("points_ingestion_log"), entries))
    return {"files": len(files), "rows": fresh.count()}


def construct(spark: SparkSession, config: PipelineConfig) -> dict[str, int]:
    """Trajectories and stops of all points newer than the last object's end, in one job over all vessel-days. Vessel-days that
    raise go to construct_errors if the settings keep errors, else they fail the job."""
    store = store_of(spark, config)
    store.require("points")
    latest = ingest.high_water_mark(store.read("trajectory_ls"), store.read("stop_poly")).first()[0]
    points = store.read("points").filter((F.col("timestamp") > F.lit(latest).cast("timestamp_ntz")) & (F.col("point_day") >= F.to_date(F.lit(latest))))
    made = staged(segment.objects(points, config.thresholds, config.partition_by_day, config.keep_errors))
    stamp = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    out = {}
    for kind, table, key, shape in (("traj", "trajectory_ls", "trajectory_id", "coords"), ("stop", "stop_poly", "stop_id", "ring")):
        rows = made.filter(F.col("kind") == kind).select("mmsi", stamp("ts_start").alias("ts_start"), stamp("ts_end").alias("ts_end"), shape)
        last = store.read(table).agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
        numbered = number(rows, key, ["mmsi", "ts_start", "ts_end"], last)
        store.append(table, numbered)
        out[table] = rows.count()
    failed = made.filter("kind = 'error'").select("mmsi", stamp("ts_start").alias("ts_start"), stamp("ts_end").alias("ts_end"), "error")
    if config.keep_errors:
        store.append("construct_errors", failed)
        out["construct_errors"] = failed.count()
    return out


def transform(spark: SparkSession, config: PipelineConfig) -> None:
    """Cells of trajectories and stops that have none yet."""
    store = store_of(spark, config)
    fresh = ingest.unconverted(store.read("trajectory_ls"), store.read("trajectory_cs"), "trajectory_id")
    store.append("trajectory_cs", staged(cells.trajectory_cells(fresh, config.zoom)))
    fresh = ingest.unconverted(store.read("stop_poly"), store.read("stop_cs"), "stop_id")
    store.append("stop_cs", staged(cells.stop_cells(fresh)))


def convert_regions(spark: SparkSession, config: PipelineConfig, regions: DataFrame | None = None) -> None:
    """Add regions (the built-in ones by default) and, at zoom 13, 17 and (unless skip_z21) 21, the cells of all regions that have none there."""
    store = store_of(spark, config)
    known = store.read("region_poly")
    new = (regions if regions is not None else reference.region_polygons(spark)).join(known.select("region_id"), "region_id", "left_anti")
    store.append("region_poly", staged(new))
    for zoom, table in ((13, "region_cs_z13"), (17, "region_cs_z17"), *(() if config.skip_z21 else ((21, "region_cs"),))):
        fresh = ingest.unconverted(store.read("region_poly"), store.read(table), "region_id")
        store.append(table, staged(cells.region_cells(fresh, zoom)))


def convert_passages(spark: SparkSession, config: PipelineConfig, passages: DataFrame | None = None) -> None:
    """Add passages (the built-in ones by default) and, at zoom 13, 17 and 21, the cells of all passages that have none there."""
    store = store_of(spark, config)
    new = (passages if passages is not None else reference.passages(spark)).join(store.read("passage_ls").select("passage_id"), "passage_id", "left_anti")
    store.append("passage_ls", staged(new))
    for zoom, table in ((13, "passage_cs_z13"), (17, "passage_cs_z17"), (21, "passage_cs")):
        fresh = ingest.unconverted(store.read("passage_ls"), store.read(table), "passage_id")
        store.append(table, staged(cells.passage_cells(fresh, zoom)))


def run_pipeline(spark: SparkSession, config: PipelineConfig) -> dict:
    """The steps that the settings switch on, in order."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    store, out = store_of(spark, config), {}
    if config.drop_ls or config.drop_cs:
        store.drop(config.drop_ls, config.drop_cs)
    if config.create_schema:
        store.create_namespaces()
    if config.create_tables:
        store.create()
    if config.point_tables:
        out["points"] = load_points(spark, config)
    if config.construct:
        out["construct"] = construct(spark, config)
    if config.transform:
        transform(spark, config)
    return out
