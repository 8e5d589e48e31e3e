"""The catalog: namespaces and Parquet tables, created, dropped, appended to and read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.schemas import CS_TABLES, LS_TABLES

PARTITIONS = {"points": "point_day"}
#: What rows have to meet to be stored: table, column that stands for it, condition.
CHECKS = {"trajectory_ls": ("ts_end", "ts_start < ts_end"), "stop_poly": ("ts_end", "ts_start < ts_end"), "trajectory_cs": ("ts_exit", "ts_entry <= ts_exit")}


def staged(df: DataFrame) -> DataFrame:
    """df written to the folder that all executors share (spark.checkpoint.dir) and read again."""
    spark = df.sparkSession
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="wakeline-staged-")
        sc.setCheckpointDir(folder)
    path = f"{folder.rstrip('/')}/wakeline-{uuid.uuid4().hex}"
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(sc._jsc.hadoopConfiguration())
    df.write.parquet(path)
    files.deleteOnExit(at)  # the table goes when the driver ends
    return spark.read.schema(df.schema).parquet(path)


class Store:
    def __init__(self, spark: SparkSession, lines: str, cells: str):
        self.spark, self.lines, self.cells = spark, lines, cells

    def name(self, table: str) -> str:
        if table in LS_TABLES:
            return f"{self.lines}.{table}"
        if table in CS_TABLES:
            return f"{self.cells}.{table}"
        raise KeyError(table)

    def create_namespaces(self) -> None:
        for name in {self.lines, self.cells}:
            self.spark.sql(f"create database if not exists `{name}`")

    def create(self) -> None:
        """All tables that are not there yet."""
        for table, schema in (LS_TABLES | CS_TABLES).items():
            if not self.exists(table) and self.spark.catalog.tableExists(f"{self.name(table)}_next"):  # replace() was cut off
                self.spark.sql(f"alter table {self.name(table)}_next rename to {self.name(table)}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            if table in PARTITIONS:
                columns += f", `{PARTITIONS[table]}` date"
            by = f" partitioned by ({PARTITIONS[table]})" if table in PARTITIONS else ""
            self.spark.sql(f"create table if not exists {self.name(table)} ({columns}) using parquet{by}")

    def drop(self, lines: bool = False, cells: bool = False) -> None:
        """Drop a group of tables. The ingestion log goes with the points: it would keep them from being loaded again."""
        for table in [*(LS_TABLES if lines else ()), *(CS_TABLES if cells else ())]:
            self.spark.sql(f"drop table if exists {self.name(table)}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def require(self, table: str) -> None:
        if not self.exists(table):
            there = ", ".join(sorted(d.name for d in self.spark.catalog.listDatabases()))
            raise ValueError(f"there is no table {self.name(table)}; namespaces that exist: {there}")

    def read(self, table: str) -> DataFrame:
        self.require(table)
        return self.spark.table(self.name(table))

    def append(self, table: str, rows: DataFrame, to: str | None = None) -> None:
        """Add rows by column name; points are laid out by day. A row that fails the table's check fails the job."""
        schema = (LS_TABLES | CS_TABLES)[table]
        out = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        if table in CHECKS:
            column, condition = CHECKS[table]
            failed = F.raise_error(f"{self.name(table)}: a row does not meet {condition}").cast("timestamp_ntz")
            out = out.withColumn(column, F.when(F.expr(condition), F.col(column)).otherwise(failed))
        if table == "points":
            out = out.withColumn("point_day", F.to_date("timestamp"))
        writer = out.write.mode("append").format("parquet")
        (writer.partitionBy(PARTITIONS[table]) if table in PARTITIONS else writer).saveAsTable(to or self.name(table))

    def replace(self, table: str, rows: DataFrame) -> None:
        """Put rows in place of a small table's; they may come from the table itself. They are written aside first: whenever this
        is cut off, the old rows or the new ones are there, and create() puts the latter in their place."""
        aside = f"{self.name(table)}_next"
        self.spark.sql(f"drop table if exists {aside}")
        self.append(table, rows, aside)
        self.spark.sql(f"drop table {self.name(table)}")
        self.spark.sql(f"alter table {aside} rename to {self.name(table)}")


def number(rows: DataFrame, key: str, order: list[str], after: int = 0) -> DataFrame:
    """rows with key, whole numbers from after + 1 on in a fixed order. Rows are dealt by ranges and numbered in each; one
    count a partition is all that comes together, so no task sorts everything."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(ranged.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    counts = dict(placed.groupBy("__part").count().collect())
    start, offsets = after, {}
    for part in sorted(counts):
        offsets[part] = start
        start += counts[part]
    if not offsets:
        return rows.limit(0).withColumn(key, F.lit(0))
    starts = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair])
    return placed.withColumn(key, (starts[F.col("__part")] + F.col("__at") + 1).cast("int")).drop("__part", "__at")
