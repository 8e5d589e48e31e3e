"""Tables of a database server, as sources of star_points() and as a sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, url: str, table: str, key: str | None = None, low: int = 0, high: int = 0, parts: int = 16, **options: str) -> DataFrame:
    """A table or query over JDBC, read in ranges of a numeric key if one is given. The driver's jar has to be there."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key:
        reader = reader.option("partitionColumn", key).option("lowerBound", low).option("upperBound", high).option("numPartitions", parts)
    return reader.load()


def write(df: DataFrame, url: str, table: str, batch: int = 5000, **options: str) -> None:
    """Append rows in batches; each partition commits its own."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch).options(**options).mode("append").save()
