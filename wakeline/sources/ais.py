"""Daily position files: discovery, pruning by date, reading, the ingestion log and the watermark."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.schemas import POINTS_INGESTION_LOG

FILE_NAME = re.compile(r"^aisdk-(\d{4}-\d{2}-\d{2})\.pq$")
COLUMNS = {"mmsi": "long", "lat": "double", "lon": "double", "sog": "double", "timestamp": "timestamp_ntz", "transponder_type": "string"}


@dataclass(frozen=True, order=True)
class DayFile:
    day: date
    name: str
    path: str


def file_date(name: str) -> date | None:
    """The day in a file's name; None for other names. An impossible day raises ValueError."""
    m = FILE_NAME.match(name)
    return date.fromisoformat(m[1]) if m else None


def discover(spark: SparkSession, folder: str) -> list[DayFile]:
    """All daily files in a folder and the folders below it, by day. Any file system that Spark reads will do."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
        raise ValueError(f"there is no folder {folder}")
    found, todo = [], [path]
    while todo:
        for status in fs.listStatus(todo.pop()):
            name = status.getPath().getName()
            day = file_date(name)
            if day is not None:  # a daily table may be one file or a folder of part files
                found.append(DayFile(day, name, status.getPath().toString()))
            elif status.isDirectory():
                todo.append(status.getPath())
    return sorted(found)


def select(files: list[DayFile], watermark: datetime | date | None = None, start: date | None = None, end: date | None = None) -> list[DayFile]:
    """Files of days after the watermark's day and within the period, both ends included."""
    seen = watermark.date() if isinstance(watermark, datetime) else watermark
    return [f for f in files if (seen is None or f.day > seen) and (start is None or f.day >= start) and (end is None or f.day <= end)]


def read(spark: SparkSession, files: list[DayFile]) -> DataFrame:
    """The used columns of all files, by name; each file's schema is cast to one."""
    rows = None
    for f in files:
        part = spark.read.parquet(f.path).select(*[F.col(c).cast(t).alias(c) for c, t in COLUMNS.items()], F.lit(f.name).alias("file_name"))
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        raise ValueError("no files to read")
    return rows


def log_entries(raw: DataFrame, files: DataFrame, loaded_at) -> DataFrame:
    """A row for each file with the first and last time in it, before any filter. files: file_name, file_path, file_date."""
    spans = raw.groupBy("file_name").agg(F.min("timestamp").alias("min_ts"), F.max("timestamp").alias("max_ts"))
    out = files.join(spans, "file_name", "left").withColumn("loaded_at", loaded_at)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in POINTS_INGESTION_LOG])


def merge_log(old: DataFrame, new: DataFrame) -> DataFrame:
    """The log with new rows in place of old ones of the same file."""
    return old.join(new.select("file_name"), "file_name", "left_anti").select(*new.columns).unionAll(new)


def watermark(log: DataFrame, points: DataFrame) -> DataFrame:
    """watermark: the last time in the log, else the last of the points, else null."""
    last = log.agg(F.max("max_ts").alias("a")).crossJoin(F.broadcast(points.agg(F.max("timestamp").alias("b"))))  # one row each
    return last.select(F.coalesce("a", "b").alias("watermark"))
