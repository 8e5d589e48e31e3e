"""From raw position reports to points: validity, duplicates, and what earlier runs have already."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The position that senders give when they have none.
NO_LATITUDE = 91.0
POINT_KEY = ["mmsi", "lat", "lon", "timestamp"]


def usable_reports(raw: DataFrame, transponder: str | None = "class a") -> DataFrame:
    """Reports that count for a vessel's validity: a position, an identity of nine digits that starts with 2 to 7, and the transponder."""
    text = F.col("mmsi").cast("string")
    ok = (F.col("lat") != NO_LATITUDE) & (F.length(text) == 9) & text.substr(1, 1).between("2", "7")
    if transponder is not None:
        ok = ok & (F.col("transponder_type") == transponder)
    return raw.filter(ok)


def valid_vessels(raw: DataFrame, least: int = 10, transponder: str | None = "class a") -> DataFrame:
    """mmsi and n_points of vessels with enough usable reports; counted before duplicates go."""
    return usable_reports(raw, transponder).groupBy("mmsi").agg(F.count("*").alias("n_points")).filter(F.col("n_points") >= least)


def clean_points(raw: DataFrame, least: int = 10, transponder: str | None = "class a", only_mmsi: int | None = None) -> DataFrame:
    """One point for each (mmsi, lat, lon, timestamp) of the valid vessels, reports of any transponder; the smallest sog
    that is not null stands for reports that repeat a point. Rows without one of the key's values go."""
    raw = raw.filter(F.col("mmsi") == only_mmsi) if only_mmsi is not None else raw
    vessels = valid_vessels(raw, least, transponder).select("mmsi")
    placed = raw.filter(F.col("lat") != NO_LATITUDE).dropna(subset=POINT_KEY).select(*POINT_KEY, "sog")
    typed = placed.join(vessels, "mmsi", "left_semi").select(F.col("mmsi").cast("long").alias("mmsi"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), F.col("sog").cast("double").alias("sog"))
    points = typed.groupBy(*POINT_KEY).agg(F.min("sog").alias("sog"))
    return points.select("mmsi", "lat", "lon", "sog", "timestamp", epoch_seconds("timestamp").alias("epoch_ts"))


def epoch_seconds(column: str):
    """Seconds since 1970 with their fraction, of a timestamp taken as UTC."""
    return F.expr(f"unix_micros(cast(`{column}` as timestamp)) / 1e6D")


def unseen_points(points: DataFrame, known: DataFrame | None) -> DataFrame:
    """Points that are not yet among the known ones, by exact equality of the key."""
    return points if known is None else points.join(known.select(*POINT_KEY), POINT_KEY, "left_anti")


def star_points(fact: DataFrame, vessels: DataFrame, days: DataFrame, times: DataFrame, least: int = 10, transponder_id: int = 5, only_mmsi: int | None = None) -> DataFrame:
    """Points from a star schema of reports: facts with vessel_id, date_id, time_id, lat, lon, sog; vessels with vessel_id, mmsi,
    transponder_type_id; days with date_id, year, month, day; times with time_id, hour, minute, second.

    Dimensions are joined by their keys; Spark broadcasts those it knows to be small. Any single vessel is a parameter."""
    stamp = F.make_timestamp_ntz("year", "month", "day", "hour", "minute", F.col("second").cast("decimal(16,6)"))
    rows = fact.join(vessels.select("vessel_id", "mmsi", "transponder_type_id"), "vessel_id").join(days, "date_id").join(times, "time_id")
    raw = rows.select("mmsi", "lat", "lon", "sog", stamp.alias("timestamp"), F.when(F.col("transponder_type_id") == transponder_id, "class a").alias("transponder_type"))
    return clean_points(raw, least, "class a", only_mmsi)


def processing_days(points: DataFrame, after=None) -> DataFrame:
    """point_day of all points newer than the high-water mark."""
    newer = points if after is None else points.filter(F.col("timestamp") > F.lit(after).cast("timestamp_ntz"))
    return newer.select(F.to_date("timestamp").alias("point_day")).distinct()


def vessel_load(points: DataFrame) -> DataFrame:
    """num_points of each vessel and day."""
    return points.groupBy("mmsi", F.to_date("timestamp").alias("point_day")).agg(F.count("*").alias("num_points"))


def high_water_mark(trajectories: DataFrame, stops: DataFrame) -> DataFrame:
    """latest_ts: the last end of a trajectory or stop; 1970 if there is none."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    ends = trajectories.select("ts_end").unionAll(stops.select("ts_end"))
    return ends.agg(F.coalesce(F.max("ts_end"), start).alias("latest_ts"))


def unconverted(objects: DataFrame, cells: DataFrame, key: str) -> DataFrame:
    """Objects that have no cells yet."""
    return objects.join(cells.select(key), key, "left_anti")


def unprocessed_vessels(points: DataFrame, trajectories: DataFrame, stops: DataFrame) -> DataFrame:
    """num_points of vessels with neither trajectories nor stops."""
    done = trajectories.select("mmsi").union(stops.select("mmsi")).distinct()
    return points.groupBy("mmsi").agg(F.count("*").alias("num_points")).join(done, "mmsi", "left_anti")
