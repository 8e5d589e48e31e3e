"""Position reports made of the events table, by one text that runs alike in Spark and DuckDB. All sums are of integers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AIS_SQL = """
with e as (
  select event_id, user_id, event_type,
         cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k,
         row_number() over (partition by user_id order by ts, event_id) as rn
  from {events}),
d as (
  select *, case when rn % 48 < 16 or rn % 48 between 28 and 31 then 0 else 1 end as ph,
         case when k = 0 then 0 when k = 1 then 4000 when k = 2 then 6000 else 30 + k % 61 end as dt
  from e),
m as (
  select *, case when ph = 0 then (k % 5) - 2 else 2500 + 5 * (k % 100) end as dlon,
         case when ph = 0 then (k % 7) - 3 else 100 * (k % 9) - 400 end as dlat
  from d),
a as (
  select *,
    sum(dt)   over (partition by user_id order by rn rows between unbounded preceding and current row) as st,
    sum(dlon) over (partition by user_id order by rn rows between unbounded preceding and current row) as sl,
    sum(dlat) over (partition by user_id order by rn rows between unbounded preceding and current row) as sa
  from m)
select case when user_id % 10 = 9 then 919000000 else 219000000 end + user_id as mmsi,
  case when event_id % 97 = 0 then 91e0
       else cast(55000000 + (user_id % 50) * 20000 + sa + case when k = 3 then 700000 else 0 end as double) / 1e6 end as lat,
  cast(10000000 + (user_id - user_id % 50) * 400 + sl as double) / 1e6 as lon,
  case when event_type = 'error' then null when ph = 0 and k % 20 = 5 then 3e0
       when ph = 0 then cast(k % 8 as double) / 1e1 else cast(6 + k % 10 as double) end as sog,
  cast(1704067200 + (user_id % 20) * 4000 + st as bigint) as epoch_ts,
  case when user_id % 10 = 8 then 'class b' else 'class a' end as transponder_type,
  event_id
from a
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def ais(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports with mmsi, lat, lon, sog, epoch_ts (long), transponder_type, event_id and timestamp."""
    rows = spark.sql(AIS_SQL, events=events(spark, sf_dir))
    return rows.withColumn("timestamp", F.timestamp_seconds("epoch_ts").cast("timestamp_ntz"))


#: DuckDB: the reports as a common table, and the points after cleaning.
AIS_CTE = f"ais as ({AIS_SQL.format(events='events')})"
POINTS_CTE = (
    AIS_CTE
    + """,
vv as (select mmsi, count(*) as n_points from ais where lat <> 91 and length(cast(mmsi as varchar)) = 9 and substr(cast(mmsi as varchar), 1, 1) between '2' and '7' and transponder_type = 'class a' group by mmsi having count(*) >= 10),
pts as (select mmsi, lat, lon, epoch_ts, min(sog) as sog, epoch_ts // 86400 as day from ais where lat <> 91 and mmsi in (select mmsi from vv) group by mmsi, lat, lon, epoch_ts)"""
)
