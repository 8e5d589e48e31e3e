"""Position reports as a stream of files: the same cleaning in micro-batches, and windowed counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.operators.ingest import clean_points, unseen_points, usable_reports
from wakeline.schemas import RAW_AIS


def report_stream(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """Daily files as they arrive; files seen are in the query's checkpoint, which is the watermark of files."""
    return spark.readStream.schema(RAW_AIS).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).option("pathGlobFilter", "aisdk-*.pq").parquet(folder)


def load_stream(stream: DataFrame, path: str, checkpoint: str, least: int = 10):
    """Clean each micro-batch, leave out points that the table at path has, and append the others by day; until the
    files that are there now are done. A batch that is run again after a failure finds its points and adds none."""

    def batch(rows: DataFrame, _: int) -> None:
        spark = rows.sparkSession
        points = clean_points(rows, least)
        try:
            known = spark.read.parquet(path)
        except Exception as e:  # the table's first batch
            if "PATH_NOT_FOUND" not in str(e):
                raise
            known = None
        days = points.select(F.to_date("timestamp").alias("point_day")).distinct()
        if known is not None:
            known = known.join(days, "point_day", "left_semi")
        unseen_points(points, known).withColumn("point_day", F.to_date("timestamp")).write.mode("append").partitionBy("point_day").parquet(path)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_reports(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """Reports without repeats, as far as the watermark reaches back."""
    timed = usable_reports(stream).withColumn("event_time", F.col("timestamp").cast("timestamp"))
    return timed.withWatermark("event_time", late).dropDuplicatesWithinWatermark(["mmsi", "lat", "lon", "timestamp"])


def vessel_activity(stream: DataFrame, late: str = "1 hour", width: str = "10 minutes") -> DataFrame:
    """Reports and mean speed of each vessel in each window; what comes later than the watermark is left out."""
    timed = usable_reports(stream).withColumn("event_time", F.col("timestamp").cast("timestamp")).withWatermark("event_time", late)
    return timed.groupBy(F.window("event_time", width), "mmsi").agg(F.count("*").alias("n_reports"), F.avg("sog").alias("mean_sog"))


def vessel_sessions(stream: DataFrame, gap: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Spans without a gap in a vessel's reports; close to, but not the same as, the segmentation's time gap."""
    timed = usable_reports(stream).withColumn("event_time", F.col("timestamp").cast("timestamp")).withWatermark("event_time", late)
    return timed.groupBy(F.session_window("event_time", gap), "mmsi").agg(F.count("*").alias("n_reports"))
