"""The registered queries of the trajectory engine, and the DuckDB SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.functions import geo
from wakeline.operators import cells, cover, ingest, segment
from wakeline.sources import ais as files
from wakeline.sources import reference
from wakeline.sources.geojson import regions
from wakeline.sources.store import number, staged

from .fixture import AIS_CTE, POINTS_CTE, ais

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def points_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.clean_points(ais(spark, sf_dir))


def _epoch(column: str = "timestamp"):
    return F.expr(f"unix_seconds(cast(`{column}` as timestamp))")


# ---- ingest ------------------------------------------------------------------------------------------------------------


@query(f"with {AIS_CTE} select mmsi, lat, lon, sog, epoch_ts, transponder_type from ais")
def ais_points_view(spark, sf):
    return ais(spark, sf).select("mmsi", "lat", "lon", "sog", "epoch_ts", "transponder_type")


@query(f"with {POINTS_CTE} select mmsi, n_points from vv")
def valid_vessels(spark, sf):
    return ingest.valid_vessels(ais(spark, sf))


@query(f"with {POINTS_CTE} select mmsi, lat, lon, epoch_ts, sog from pts")
def points_dedup(spark, sf):
    return points_of(spark, sf).select("mmsi", "lat", "lon", F.col("epoch_ts").cast("long").alias("epoch_ts"), "sog")


@query(f"with {POINTS_CTE} select mmsi, lat, lon, epoch_ts from pts where not exists (select 1 from ais a where a.event_id % 2 = 0 and a.mmsi = pts.mmsi and a.lat = pts.lat and a.lon = pts.lon and a.epoch_ts = pts.epoch_ts)")
def points_unseen(spark, sf):
    known = ais(spark, sf).filter("event_id % 2 = 0")
    return ingest.unseen_points(points_of(spark, sf), known).select("mmsi", "lat", "lon", F.col("epoch_ts").cast("long").alias("epoch_ts"))


def _day_files(spark, sf) -> DataFrame:
    return ais(spark, sf).withColumn("file_name", F.concat(F.lit("aisdk-"), F.to_date("timestamp").cast("string"), F.lit(".pq")))


_FILES = "fl as (select 'aisdk-' || strftime(make_timestamp(epoch_ts * 1000000), '%Y-%m-%d') || '.pq' as file_name, epoch_ts from ais)"


@query(f"with {AIS_CTE}, {_FILES} select file_name, min(epoch_ts) as min_ts, max(epoch_ts) as max_ts from fl group by file_name")
def ingestion_log(spark, sf):
    raw = _day_files(spark, sf)
    named = raw.select("file_name").distinct().select("file_name", F.col("file_name").alias("file_path"), F.to_date(F.regexp_extract("file_name", r"^aisdk-(\d{4}-\d{2}-\d{2})\.pq$", 1)).alias("file_date"))
    log = files.log_entries(raw, named, F.localtimestamp())
    return log.select("file_name", _epoch("min_ts").alias("min_ts"), _epoch("max_ts").alias("max_ts"))


@query(f"with {AIS_CTE}, {_FILES} select file_name, count(*) as n_rows from fl group by file_name")
def log_merge(spark, sf):
    """Rows of each file after a log with a stale entry for every file has been merged with the new one."""
    raw = _day_files(spark, sf)
    new = raw.groupBy("file_name").agg(F.count("*").alias("n_rows"))
    return files.merge_log(new.withColumn("n_rows", F.lit(0).cast("long")), new)


@query(f"with {AIS_CTE} select max(epoch_ts) as watermark from ais")
def ingestion_watermark(spark, sf):
    raw = _day_files(spark, sf)
    log = raw.groupBy("file_name").agg(F.max("timestamp").alias("max_ts"))
    return files.watermark(log, raw).select(_epoch("watermark").alias("watermark"))


@query(f"with {AIS_CTE}, d as (select distinct cast(make_timestamp(epoch_ts * 1000000) as date) as day from ais) select cast(day as varchar) as day from d where day > date '2024-01-01' and day between date '2024-01-02' and date '2024-01-03'")
def file_pruning(spark, sf):
    """Days that a watermark on 2024-01-01 and the period 2024-01-02 to 2024-01-03 leave."""
    days = ais(spark, sf).select(F.to_date("timestamp").alias("day")).distinct()
    return days.filter((F.col("day") > F.lit("2024-01-01").cast("date")) & F.col("day").between("2024-01-02", "2024-01-03")).select(F.col("day").cast("string").alias("day"))


@query(f"with {POINTS_CTE} select distinct cast(make_timestamp(epoch_ts * 1000000) as date)::varchar as point_day from pts where epoch_ts > 1704067200")
def processing_days(spark, sf):
    return ingest.processing_days(points_of(spark, sf), "2024-01-01 00:00:00").select(F.col("point_day").cast("string").alias("point_day"))


@query(f"with {POINTS_CTE} select mmsi, cast(make_timestamp(epoch_ts * 1000000) as date)::varchar as point_day, count(*) as num_points from pts group by all")
def vessel_load(spark, sf):
    return ingest.vessel_load(points_of(spark, sf)).select("mmsi", F.col("point_day").cast("string").alias("point_day"), "num_points")


@query(f"with {POINTS_CTE} select coalesce(max(epoch_ts), 0) as latest_ts from pts")
def high_water_mark(spark, sf):
    ends = points_of(spark, sf).groupBy("mmsi").agg(F.max("timestamp").alias("ts_end"))
    return ingest.high_water_mark(ends.filter("mmsi % 2 = 0"), ends.filter("mmsi % 2 = 1")).select(_epoch("latest_ts").alias("latest_ts"))


@query(
    "with v as (select c_custkey from customer join orders on o_custkey = c_custkey where length(cast(c_custkey as varchar)) >= 1 group by c_custkey having count(*) >= 10) "
    "select o_orderkey, c_custkey, n_name, r_name from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where c_custkey in (select c_custkey from v)"
)
def star_points(spark, sf):
    """The shape of the star-schema source over the sales tables: a fact, three dimensions, and keys with ten facts or more."""
    t = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    facts = t("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    valid = facts.groupBy("c_custkey").count().filter("count >= 10").select("c_custkey")
    rows = facts.join(valid, "c_custkey", "left_semi").join(t("customer").select("c_custkey", "c_nationkey"), "c_custkey")
    rows = rows.join(t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"), "c_nationkey")
    return rows.join(t("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey").select("o_orderkey", "c_custkey", "n_name", "r_name")


_STAR = (
    f"with {AIS_CTE}, f as (select * from ais where transponder_type = 'class a' and lat <> 91 and length(cast(mmsi as varchar)) = 9 and substr(cast(mmsi as varchar), 1, 1) between '2' and '7'), "
    "v as (select mmsi from f group by mmsi having count(*) >= 10) select mmsi, lat, lon, epoch_ts from ais where lat <> 91 and mmsi in (select mmsi from v) group by all"
)


@query(_STAR)
def star_schema_points(spark, sf):
    """Points from a fact table with vessel, day and time dimensions, as the reports would be kept in a warehouse."""
    raw = ais(spark, sf)
    fact = raw.select(F.col("mmsi").alias("vessel_id"), F.date_format("timestamp", "yyyyMMdd").cast("int").alias("date_id"), F.date_format("timestamp", "HHmmss").cast("int").alias("time_id"), "lat", "lon", "sog")
    vessels = raw.select(F.col("mmsi").alias("vessel_id"), "mmsi", F.when(F.col("transponder_type") == "class a", 5).otherwise(6).alias("transponder_type_id")).distinct()
    days = fact.select("date_id").distinct().select("date_id", F.expr("date_id div 10000").cast("int").alias("year"), F.expr("date_id div 100 % 100").cast("int").alias("month"), F.expr("date_id % 100").cast("int").alias("day"))
    times = fact.select("time_id").distinct().select("time_id", F.expr("time_id div 10000").cast("int").alias("hour"), F.expr("time_id div 100 % 100").cast("int").alias("minute"), F.expr("time_id % 100").cast("int").alias("second"))
    return ingest.star_points(fact, vessels, days, times).select("mmsi", "lat", "lon", F.col("epoch_ts").cast("long").alias("epoch_ts"))


# ---- scalars -----------------------------------------------------------------------------------------------------------

_HAVERSINE = "6371000.0 * 2 * asin(sqrt(pow(sin((radians({b}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({b})) * pow(sin((radians({d}) - radians({c})) / 2), 2)))"


def _haversine(lon1, lat1, lon2, lat2) -> str:
    return _HAVERSINE.format(a=lat1, b=lat2, c=lon1, d=lon2)


_LAG = (
    f"with {POINTS_CTE}, l as (select *, lag(epoch_ts) over w as pt, lag(lon) over w as plon, lag(lat) over w as plat from pts window w as (partition by mmsi order by epoch_ts, lat, lon)), "
    f"m as (select mmsi, epoch_ts, lat, lon, epoch_ts - pt as dt, {_haversine('plon', 'plat', 'lon', 'lat')} as dist from l where pt is not null) "
)


def _motion(spark, sf) -> DataFrame:
    w = Window.partitionBy("mmsi").orderBy("epoch_ts", "lat", "lon")
    p = points_of(spark, sf).withColumn("epoch_ts", F.col("epoch_ts").cast("long"))
    p = p.withColumns({"pt": F.lag("epoch_ts").over(w), "plon": F.lag("lon").over(w), "plat": F.lag("lat").over(w)}).filter("pt is not null")
    return p.select("mmsi", "epoch_ts", "lat", "lon", (F.col("epoch_ts") - F.col("pt")).alias("dt"), geo.haversine_m(F.col("plon"), F.col("plat"), F.col("lon"), F.col("lat")).alias("dist"))


@query(_LAG + "select mmsi, epoch_ts, lat, lon, dt, round(dist, 3) as dist_m from m")
def motion_lag(spark, sf):
    return _motion(spark, sf).select("mmsi", "epoch_ts", "lat", "lon", "dt", F.round("dist", 3).alias("dist_m"))


@query(_LAG + "select mmsi, epoch_ts, lat, lon, case when dt > 0 then round(dist / dt / 0.514444, 4) else -1 end as knots from m")
def haversine_speed(spark, sf):
    speed = geo.speed_kn(F.col("dist"), F.col("dt"))
    return _motion(spark, sf).select("mmsi", "epoch_ts", "lat", "lon", F.when(speed == F.lit(float("inf")), F.lit(-1.0)).otherwise(F.round(speed, 4)).alias("knots"))


def _x(z: int, lon: str = "lon") -> str:
    return f"({1 << z}::double * ({lon} / 360.0 + 0.5))"


def _y(z: int, lat: str = "lat") -> str:
    s = f"sin({lat} * pi() / 180.0)"
    return f"greatest(0.0, least({(1 << z) - 1}::double, {1 << z}::double * (0.5 - 0.25 * ln((1 + {s}) / (1 - {s})) / pi())))"


def _morton(x: str, y: str) -> str:
    nest = lambda v: f"list_reduce([{v}, 16, 8, 4, 2, 1], lambda a, s: (a | (a << s)) & case s when 16 then {0x0000FFFF0000FFFF} when 8 then {0x00FF00FF00FF00FF} when 4 then {0x0F0F0F0F0F0F0F0F} when 2 then {0x3333333333333333} else {0x5555555555555555} end)"
    return f"({nest(f'({x})::bigint')} | ({nest(f'({y})::bigint')} << 1))"


def _cell(z: int, lon: str = "lon", lat: str = "lat") -> str:
    return _morton(f"floor({_x(z, lon)})", f"floor({_y(z, lat)})")


@query(f"with {POINTS_CTE} select mmsi, epoch_ts, lat, lon, round({_x(21)}, 3) as x, round({_y(21)}, 3) as y from pts")
def tile_fraction(spark, sf):
    p = points_of(spark, sf)
    return p.select("mmsi", F.col("epoch_ts").cast("long").alias("epoch_ts"), "lat", "lon", F.round(geo.tile_fraction_x(F.col("lon"), 21), 3).alias("x"), F.round(geo.tile_fraction_y(F.col("lat"), 21), 3).alias("y"))


def _cell_query(zoom: int):
    def f(spark, sf):
        return points_of(spark, sf).select("mmsi", F.col("epoch_ts").cast("long").alias("epoch_ts"), "lat", "lon", geo.lonlat_cell(F.col("lon"), F.col("lat"), zoom).alias("cell"))

    f.__name__ = f"cell_id_z{zoom}"
    return query(f"with {POINTS_CTE} select mmsi, epoch_ts, lat, lon, {_cell(zoom)} as cell from pts")(f)


for _zoom in (13, 17, 21):
    _cell_query(_zoom)


@query(f"with {POINTS_CTE}, c as (select distinct {_cell(21)} as cell from pts) select cell, cell >> 8 as cell_z17, cell >> 16 as cell_z13 from c")
def cell_parent(spark, sf):
    c = points_of(spark, sf).select(geo.lonlat_cell(F.col("lon"), F.col("lat"), 21).alias("cell")).distinct()
    return c.select("cell", geo.parent_cell(F.col("cell"), 21, 17).alias("cell_z17"), geo.parent_cell(F.col("cell"), 21, 13).alias("cell_z13"))


@query(f"with {POINTS_CTE}, c as (select distinct {_cell(13)} as cell from pts) select cell, unnest(range(cell << 4, (cell << 4) + 16)) as child from c")
def cell_children(spark, sf):
    c = points_of(spark, sf).select(geo.lonlat_cell(F.col("lon"), F.col("lat"), 13).alias("cell")).distinct()
    return c.select("cell", F.explode(geo.child_cells(F.col("cell"), 13, 15)).alias("child"))


@query(f"with {POINTS_CTE}, c as (select distinct floor({_x(17)})::bigint as x, floor({_y(17)})::bigint as y from pts) select x, y, round(x / 131072.0 * 360 - 180, 9) as west, round(degrees(atan((exp(pi() * (1 - 2.0 * y / 131072)) - exp(-pi() * (1 - 2.0 * y / 131072))) / 2)), 9) as north from c")
def tile_bounds(spark, sf):
    p = points_of(spark, sf).select(geo.tile_x(F.col("lon"), 17).alias("x"), geo.tile_y(F.col("lat"), 17).alias("y")).distinct()
    b = geo.tile_bounds(F.col("x"), F.col("y"), 17)
    return p.select("x", "y", F.round(b["west"], 9).alias("west"), F.round(b["north"], 9).alias("north"))


_DECIMAL = "(100000000000000 + floor({x})::bigint * 10000000 + floor({y})::bigint)"


@query(f"with {POINTS_CTE} select mmsi, epoch_ts, lat, lon, {_DECIMAL.format(x=_x(21), y=_y(21))} as cell from pts")
def deprecated_encode(spark, sf):
    return points_of(spark, sf).select("mmsi", F.col("epoch_ts").cast("long").alias("epoch_ts"), "lat", "lon", geo.decimal_lonlat_cell(F.col("lon"), F.col("lat"), 21).alias("cell"))


@query(f"with {POINTS_CTE}, c as (select distinct {_DECIMAL.format(x=_x(21), y=_y(21))} as cell from pts) select cell, (cell - 100000000000000) // 10000000 as x, (cell - 100000000000000) % 10000000 as y from c")
def deprecated_decode(spark, sf):
    c = points_of(spark, sf).select(geo.decimal_lonlat_cell(F.col("lon"), F.col("lat"), 21).alias("cell")).distinct()
    return c.select("cell", geo.decimal_cell_x(F.col("cell"), 21).alias("x"), geo.decimal_cell_y(F.col("cell"), 21).alias("y"))


@query(f"with {POINTS_CTE} select {_cell(17)} as cell, count(*) as n_points, count(distinct mmsi) as n_vessels from pts group by 1")
def points_per_cell(spark, sf):
    p = points_of(spark, sf).select("mmsi", geo.lonlat_cell(F.col("lon"), F.col("lat"), 17).alias("cell"))
    return p.groupBy("cell").agg(F.count("*").alias("n_points"), F.countDistinct("mmsi").alias("n_vessels"))


@query(f"with {POINTS_CTE} select mmsi, count(distinct {_cell(21)}) as n_cells from pts group by mmsi")
def vessel_cells(spark, sf):
    p = points_of(spark, sf).select("mmsi", geo.lonlat_cell(F.col("lon"), F.col("lat"), 21).alias("cell"))
    return p.distinct().groupBy("mmsi").agg(F.count("*").alias("n_cells"))


@query(f"with {POINTS_CTE} select mmsi, round(sum(lon) / count(*), 7) as lon, round(sum(lat) / count(*), 7) as lat from pts group by mmsi")
def vessel_centroid(spark, sf):
    return points_of(spark, sf).groupBy("mmsi").agg(F.round(F.sum("lon") / F.count("*"), 7).alias("lon"), F.round(F.sum("lat") / F.count("*"), 7).alias("lat"))


@query(f"with {POINTS_CTE}, b as (select mmsi, min(lon) as w, min(lat) as s, max(lon) as e, max(lat) as n from pts group by mmsi) select mmsi, round({_haversine('w', 's', 'e', 's')} * {_haversine('w', 's', 'w', 'n')} / 1e6, 3) as km2 from b")
def vessel_mbr_area(spark, sf):
    b = points_of(spark, sf).groupBy("mmsi").agg(F.min("lon").alias("w"), F.min("lat").alias("s"), F.max("lon").alias("e"), F.max("lat").alias("n"))
    return b.select("mmsi", F.round(geo.mbr_area_m2(F.col("w"), F.col("s"), F.col("e"), F.col("n")) / 1e6, 3).alias("km2"))


# ---- covers ------------------------------------------------------------------------------------------------------------


def _passage_sql(zoom: int, select: str, lines: list = reference.PASSAGES) -> str:
    rows = ", ".join(f"({i}, '{name}', {a[0]!r}::double, {a[1]!r}::double, {b[0]!r}::double, {b[1]!r}::double)" for i, (name, a, b) in enumerate(lines, 1))
    ends = f"e as (select id, name, {_x(zoom, 'lon0')} as x0, {_y(zoom, 'lat0')} as y0, {_x(zoom, 'lon1')} as x1, {_y(zoom, 'lat1')} as y1 from (values {rows}) as t(id, name, lon0, lat0, lon1, lat1))"
    start = "s as (select *, x1 - x0 as dx, y1 - y0 as dy from e)"
    walk = (
        "w as (select id, name, 0 as pos, floor(x0)::bigint as x, floor(y0)::bigint as y, sign(dx)::bigint as sx, sign(dy)::bigint as sy, "
        "abs(((case when dx > 0 then 1 else 0 end) + floor(x0) - x0) / dx) as tx, abs(((case when dy > 0 then 1 else 0 end) + floor(y0) - y0) / dy) as ty, abs(1 / dx) as stepx, abs(1 / dy) as stepy from s "
        "union all select id, name, pos + 1, case when tx < ty then x + sx else x end, case when tx < ty then y else y + sy end, sx, sy, case when tx < ty then tx + stepx else tx end, case when tx < ty then ty else ty + stepy end, stepx, stepy from w where tx < 1 or ty < 1)"
    )
    return f"with recursive {ends}, {start}, {walk} {select}"


def _passage_query(zoom: int):
    def f(spark, sf):
        return cells.passage_cells(reference.passages(spark), zoom).select("name", "pos", F.col(f"cell_z{zoom}").alias("cell"))

    f.__name__ = f"passage_cover_z{zoom}"
    return query(_passage_sql(zoom, f"select name, pos, {_morton('x', 'y')} as cell from w"))(f)


for _zoom in (13, 17, 21):
    _passage_query(_zoom)


@query(_passage_sql(17, f"select name, count(*) as n_z17, string_agg(({_morton('x', 'y')})::varchar, ',' order by pos) as cells from w group by name"))
def cellstring_array(spark, sf):
    """The array form of passages at zoom 17, written out."""
    a = cells.passage_arrays(reference.passages(spark))
    return a.select("name", F.size("cellstring_z17").cast("long").alias("n_z17"), F.array_join(F.col("cellstring_z17").cast("array<string>"), ",").alias("cells"))


#: Rectangles where the made-up vessels are, and lines that they cross.
AREAS = [("west", 9.9, 55.0, 10.15, 55.5), ("east", 10.2, 55.3, 10.6, 56.1)]
LINES = [("western line", (10.05, 55.0), (10.06, 56.2)), ("eastern line", (10.3, 56.2), (10.28, 55.0))]


def _region_sql(zoom: int, names: tuple[str, ...], select: str) -> str:
    rows = ", ".join(f"('{n}', {w!r}::double, {s!r}::double, {e!r}::double, {t!r}::double)" for n, w, s, e, t in [*reference.REGIONS, *AREAS] if n in names)
    box = f"b as (select name, floor({_x(zoom, 'w')})::bigint as x0, floor({_x(zoom, 'e')})::bigint as x1, floor({_y(zoom, 'n')})::bigint as y0, floor({_y(zoom, 's')})::bigint as y1 from (values {rows}) as t(name, w, s, e, n))"
    tiles = "c as (select name, x, unnest(range(y0, y1 + 1)) as y from (select name, y0, y1, unnest(range(x0, x1 + 1)) as x from b))"
    return f"with {box}, {tiles} {select}"


_ALL = tuple(r[0] for r in reference.REGIONS)


@query(_region_sql(17, _ALL, f"select name, {_morton('x', 'y')} as cell from c"))
def region_cover_z17(spark, sf):
    return cells.region_cells(reference.region_polygons(spark), 17).select("name", F.col("cell_z17").alias("cell"))


@query(_region_sql(21, _ALL, f", k as (select name, {_morton('x', 'y')} as cell from c) select name, cell >> 16 as tile, count(*) as n_cells, min(cell) as first, max(cell) as last, sum(cell & 65535)::bigint as places from k group by 1, 2").replace("c , k", "c, k"))
def region_cover_z21(spark, sf):
    """The cells of all regions at zoom 21, some eleven million, summed up by their zoom-13 tile."""
    k = cells.region_cells(reference.region_polygons(spark), 21).withColumn("cell", F.col("cell_z21"))
    sums = [F.count("*").alias("n_cells"), F.min("cell").alias("first"), F.max("cell").alias("last"), F.sum(F.col("cell").bitwiseAND(65535)).alias("places")]
    return k.groupBy("name", F.shiftright("cell", 16).alias("tile")).agg(*sums)


@query(_region_sql(13, _ALL, f"select name, {_morton('x', 'y')} as cell from c"))
def region_cover_z13_flat(spark, sf):
    done = cover.flat_polygon_cover(reference.region_polygons(spark), 13)
    return done.select("name", F.explode("cells").alias("cell"))


@query(_region_sql(17, _ALL, f", k as (select name, {_morton('x', 'y')} as cell from c) select name, count(*) as n_z17, string_agg(cell::varchar, ',' order by cell) as cells from k group by name").replace("c , k", "c, k"))
def region_arrays(spark, sf):
    a = cells.polygon_arrays(reference.region_polygons(spark), skip_z21=True)
    return a.select("name", F.size("cellstring_z17").cast("long").alias("n_z17"), F.array_join(F.array_sort("cellstring_z17").cast("array<string>"), ",").alias("cells"))


@query(
    _region_sql(13, _ALL, ", t as (select b.*, x, unnest(range(y0 - 1, y1 + 2)) as y from (select *, unnest(range(x0 - 1, x1 + 2)) as x from b) b) select name, x, y, case when x > x0 and x < x1 and y > y0 and y < y1 then 2 when x between x0 and x1 and y between y0 and y1 then 1 else 0 end as kind from t").replace("c , t", "c, t")
)
def tile_classification(spark, sf):
    """Zoom-13 tiles of all regions and one tile around them: inside, on the border, and outside."""
    shapes = reference.region_polygons(spark).select("name", "geom")
    tiles = cover.flat_polygon_cover(shapes, 13).select("name", F.explode("cells").alias("cell"))
    x, y = geo.cell_x(F.col("cell")), geo.cell_y(F.col("cell"))
    box = tiles.groupBy("name").agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    grown = lambda a, b: F.explode(F.sequence(F.col(a) - 1, F.col(b) + 1))
    placed = box.select("name", "y0", "y1", grown("x0", "x1").alias("x")).select("name", "x", grown("y0", "y1").alias("y")).join(shapes, "name")
    return cover.classify_tiles(placed, "geom", "x", "y", 13).select("name", "x", "y", "kind")


def _areas(spark) -> DataFrame:
    return regions(spark, [(i, name, [reference.rectangle(*box)]) for i, (name, *box) in enumerate(AREAS, 1)])


@query(
    _region_sql(17, ("west", "east"), f", k as (select name, {_morton('x', 'y')} as cell from c), {POINTS_CTE} select name, count(*) as n_points, count(distinct mmsi) as n_vessels from (select mmsi, {_cell(17)} as cell from pts) p join k on p.cell = k.cell group by name").replace("c , k", "c, k")
)
def point_region_join(spark, sf):
    """Points in the cells of two areas at zoom 17."""
    visits = points_of(spark, sf).select("mmsi", geo.lonlat_cell(F.col("lon"), F.col("lat"), 17).alias("cell"))
    places = cells.region_cells(_areas(spark), 17).select("name", F.col("cell_z17").alias("cell"))
    return cells.join_cells_coarse(visits, places, "name", "cell", 8).groupBy("name").agg(F.count("*").alias("n_points"), F.countDistinct("mmsi").alias("n_vessels"))


# ---- segmentation ------------------------------------------------------------------------------------------------------

_RANKED = f"{POINTS_CTE}, p as (select *, row_number() over (partition by mmsi, day order by epoch_ts, lat, lon) as rn from pts)"
_FOLD = (
    _RANKED
    + f""",
f as (
  select mmsi, day, rn, lon as plon, lat as plat, epoch_ts as pts_, epoch_ts, lat, lon, 'init' as label from p where rn = 1
  union all
  select mmsi, day, rn,
    case when label in ('dup', 'outlier') then plon else lon end, case when label in ('dup', 'outlier') then plat else lat end,
    case when label in ('dup', 'outlier') then pts_ else epoch_ts end, epoch_ts, lat, lon, label
  from (
    select *, case when dt = 0 then 'dup'
      when coalesce(sog, knots) < 1 and dt < 5400 and dist < 250 then 'stop'
      when knots >= 50 then 'outlier' when dt < 3600 then 'move' else 'gap' end as label
    from (
      select *, case when dt > 0 then dist / dt / 0.514444 else 'inf'::double end as knots
      from (
        select p.mmsi, p.day, p.rn, p.sog, p.epoch_ts, p.lat, p.lon, f.plon, f.plat, f.pts_, p.epoch_ts - f.pts_ as dt,
          {_haversine('f.plon', 'f.plat', 'p.lon', 'p.lat')} as dist
        from f join p on p.mmsi = f.mmsi and p.day = f.day and p.rn = f.rn + 1) a) b) c)"""
)
_SEGMENTS = (
    _FOLD
    + """,
eff as (select *, row_number() over w as i, lag(label) over w as plabel, lag(epoch_ts) over w as before, lag(rn) over w as brn, lag(lon) over w as blon, lag(lat) over w as blat
  from f where label not in ('dup', 'outlier') window w as (partition by mmsi, day order by rn)),
run as (select *, sum(case when label is distinct from plabel or label = 'gap' then 1 else 0 end) over (partition by mmsi, day order by i) as g from eff),
seg as (select mmsi, day, g, label, list_prepend(arg_min(brn, i), list(rn order by i)) as nodes, count(*) + 1 as n_points, min(before) as ts_start, max(epoch_ts) as ts_end,
  sum(lon) + arg_min(blon, i) as sx, sum(lat) + arg_min(blat, i) as sy,
  least(min(lon), arg_min(blon, i)) as w, least(min(lat), arg_min(blat, i)) as s, greatest(max(lon), arg_min(blon, i)) as e, greatest(max(lat), arg_min(blat, i)) as n
  from run where label in ('stop', 'move') group by mmsi, day, g, label)"""
)
_MERGE = (
    _SEGMENTS
    + f""",
st as (select *, row_number() over (partition by mmsi, day order by ts_start, ts_end) as k from seg where label = 'stop'),
mg as (
  select mmsi, day, k, 1 as gid, n_points, ts_start, ts_end, sx, sy, w, s, e, n from st where k = 1
  union all
  select mmsi, day, k, case when near then gid else gid + 1 end, case when near then an + n_points else n_points end, case when near then ats else ts_start end, ts_end,
    case when near then asx + sx else sx end, case when near then asy + sy else sy end, case when near then least(aw, w) else w end, case when near then least(as_, s) else s end,
    case when near then greatest(ae, e) else e end, case when near then greatest(an_, n) else n end
  from (
    select st.*, mg.gid, mg.n_points as an, mg.ts_start as ats, mg.sx as asx, mg.sy as asy, mg.w as aw, mg.s as as_, mg.e as ae, mg.n as an_,
      st.ts_start - mg.ts_end < 3600 and {_haversine('mg.sx / mg.n_points', 'mg.sy / mg.n_points', 'st.sx / st.n_points', 'st.sy / st.n_points')} < 50 as near
    from mg join st on st.mmsi = mg.mmsi and st.day = mg.day and st.k = mg.k + 1) x),
merged as (select mmsi, day, gid, arg_max(n_points, k) as n_points, arg_max(ts_start, k) as ts_start, max(ts_end) as ts_end, arg_max(w, k) as w, arg_max(s, k) as s, arg_max(e, k) as e, arg_max(n, k) as n from mg group by mmsi, day, gid)"""
)


@query(f"with recursive {_FOLD} select mmsi, epoch_ts, lat, lon, label from f")
def point_labels(spark, sf):
    return segment.point_labels(points_of(spark, sf)).withColumn("epoch_ts", F.col("epoch_ts").cast("long"))


@query(f"with recursive {_SEGMENTS} select mmsi, case label when 'stop' then 'stop' else 'traj' end as kind, n_points, ts_start, ts_end from seg")
def candidate_segments(spark, sf):
    done = segment.candidate_segments(points_of(spark, sf))
    return done.select("mmsi", "kind", "n_points", F.col("ts_start").cast("long").alias("ts_start"), F.col("ts_end").cast("long").alias("ts_end"))


_AREA = f"{_haversine('w', 's', 'e', 's')} * {_haversine('w', 's', 'w', 'n')}"
_VALID = f"(n_points >= 10 and ts_end - ts_start >= 600 and ((w = e and s = n) or (w < e and s < n and {_AREA} <= 5000000)))"


@query(f"with recursive {_MERGE} select mmsi, n_points, ts_start, ts_end, {_VALID} as is_valid from merged")
def merged_stops(spark, sf):
    done = segment.candidate_segments(points_of(spark, sf), merged=True)
    return done.select("mmsi", "n_points", F.col("ts_start").cast("long").alias("ts_start"), F.col("ts_end").cast("long").alias("ts_end"), "is_valid")


@query(f"with {POINTS_CTE}, g as (select mmsi, epoch_ts // 1800 as slot, count(*) as n_points, max(epoch_ts) - min(epoch_ts) as duration, min(lon) as w, min(lat) as s, max(lon) as e, max(lat) as n from pts group by all) select mmsi, slot, n_points, duration, (n_points >= 10 and duration >= 600 and ((w = e and s = n) or (w < e and s < n and {_AREA} <= 5000000))) as is_valid from g")
def stop_validity(spark, sf):
    """Validity of each vessel's half hours as if they were stops, by aggregates alone."""
    p = points_of(spark, sf).withColumn("slot", F.floor(F.col("epoch_ts") / 1800).cast("long"))
    return segment.stop_validity(p, ["mmsi", "slot"])


def _objects(spark, sf, kind: str) -> DataFrame:
    return segment.objects(points_of(spark, sf)).filter(F.col("kind") == kind)


#: Invalid stops are taken one after the other; moves holds the trajectories of a vessel's day as lists of point numbers.
_MOVES = (
    _MERGE
    + f""",
parts as (select mg.mmsi, mg.day, mg.gid, flatten(list(st.nodes order by st.k)) as nodes from mg join st on st.mmsi = mg.mmsi and st.day = mg.day and st.k = mg.k group by mg.mmsi, mg.day, mg.gid),
bad as (select parts.* from parts join merged using (mmsi, day, gid) where not {_VALID}),
legs as (select mmsi, day, gid, nodes, unnest(range(1, len(nodes))) as j from bad),
torn as (
  select l.mmsi, l.day, l.gid, bool_or(b.epoch_ts - a.epoch_ts > 3600 or b.epoch_ts <= a.epoch_ts or {_haversine('a.lon', 'a.lat', 'b.lon', 'b.lat')} / (b.epoch_ts - a.epoch_ts) / 0.514444 > 50) as is_torn
  from legs l join p a on a.mmsi = l.mmsi and a.day = l.day and a.rn = l.nodes[l.j] join p b on b.mmsi = l.mmsi and b.day = l.day and b.rn = l.nodes[l.j + 1] group by all),
todo as (select mmsi, day, nodes, row_number() over (partition by mmsi, day order by gid) as k from bad join torn using (mmsi, day, gid) where not is_torn),
ab as (
  select mmsi, day, 0::bigint as k, moves from (select mmsi, day, list(nodes order by g) filter (label = 'move') as moves from seg group by mmsi, day) where true
  union all
  select mmsi, day, k, case
      when b is not null and a is not null and a <> b then list_filter(list_transform(moves, lambda m, i: case when i = b then m || nodes || moves[a] else m end), lambda m, i: i <> a)
      when b is not null then list_transform(moves, lambda m, i: case when i = b then m || nodes else m end)
      when a is not null then list_transform(moves, lambda m, i: case when i = a then nodes || m else m end)
      when len(nodes) >= 10 then list_append(moves, nodes) else moves end
  from (
    select t.mmsi, t.day, t.k, t.nodes, ab.moves,
      list_max(list_filter(range(1, coalesce(len(ab.moves), 0) + 1), lambda i: ab.moves[i][-1] = t.nodes[1])) as b, list_max(list_filter(range(1, coalesce(len(ab.moves), 0) + 1), lambda i: ab.moves[i][1] = t.nodes[-1])) as a
    from ab join todo t on t.mmsi = ab.mmsi and t.day = ab.day and t.k = ab.k + 1) x),
made as (select mmsi, day, unnest(moves) as nodes from (select mmsi, day, arg_max(moves, k) as moves from ab group by mmsi, day)),
vx as (
  select row_number() over () as rid, m.mmsi, m.day, m.nodes from made m where len(m.nodes) >= 10),
vp as (select rid, mmsi, day, unnest(nodes) as rn, unnest(range(1, len(nodes) + 1)) as i from vx),
vt as (select rid, mmsi, i, lon, lat, epoch_ts from vp join p using (mmsi, day, rn)),
tr as (select row_number() over (order by mmsi, ts_start, ts_end) as trajectory_id, * from (select rid, mmsi, arg_min(epoch_ts, i) as ts_start, arg_max(epoch_ts, i) as ts_end, count(*) as n_points,
  string_agg(concat_ws(':', epoch_ts, round(lon * 1e6)::bigint, round(lat * 1e6)::bigint), ',' order by i) as points from vt group by rid, mmsi) where ts_end > ts_start)"""
)
#: The walk of each pair of vertices from grid line to grid line, and the visits of cells that follow from it.
_VISITS = (
    _MOVES
    + f""",
fr as (select trajectory_id, vt.i, vt.epoch_ts, {_x(21, 'vt.lon')} as x, {_y(21, 'vt.lat')} as y from vt join tr using (rid)),
pr as (select *, x1 - x as dx, y1 - y as dy from (select *, lead(x) over o as x1, lead(y) over o as y1, lead(epoch_ts) over o as t1 from fr window o as (partition by trajectory_id order by i)) where x1 is not null),
wk as (
  select trajectory_id, i, 0 as step, floor(x)::bigint as cx, floor(y)::bigint as cy, sign(dx)::bigint as sx, sign(dy)::bigint as sy,
    case when dx = 0 then 'inf'::double else abs(((case when dx > 0 then 1 else 0 end) + floor(x) - x) / dx) end as tx, case when dy = 0 then 'inf'::double else abs(((case when dy > 0 then 1 else 0 end) + floor(y) - y) / dy) end as ty,
    case when dx = 0 then 'inf'::double else abs(1 / dx) end as stepx, case when dy = 0 then 'inf'::double else abs(1 / dy) end as stepy
  from pr where i = 1 or dx <> 0 or dy <> 0
  union all
  select trajectory_id, i, step + 1, case when tx < ty then cx + sx else cx end, case when tx < ty then cy else cy + sy end, sx, sy,
    case when tx < ty then tx + stepx else tx end, case when tx < ty then ty else ty + stepy end, stepx, stepy from wk where tx < 1 or ty < 1),
timed as (
  select trajectory_id, i, step, cx, cy, case when n = 0 then epoch_ts else case when even - floor(even) = 0.5 then floor(even) + floor(even) % 2 else floor(even + 0.5) end::bigint end as ts
  from (select wn.*, pr.epoch_ts, case when n = 0 then null else pr.epoch_ts + step::double / n * (pr.t1 - pr.epoch_ts) end as even
    from (select trajectory_id, i, step, cx, cy, max(step) over (partition by trajectory_id, i) as n from wk) wn join pr using (trajectory_id, i))),
fresh as (select * from (select *, lag(cx) over o as px, lag(cy) over o as py from timed window o as (partition by trajectory_id order by i, step)) where px is null or px <> cx or py <> cy),
visit as (
  select trajectory_id, mmsi, (row_number() over o - 1)::integer as pos, {_morton('cx', 'cy')} as cell_z21, ts as ts_entry, greatest(ts, coalesce(lead(ts) over o, ts_end)) as ts_exit
  from fresh join tr using (trajectory_id) window o as (partition by trajectory_id order by i, step))"""
)


@query(f"with recursive {_MOVES} select mmsi, ts_start, ts_end, n_points, points from tr")
def trajectories(spark, sf):
    """Trajectories with their vertices written out, in whole seconds and millionths of a degree."""
    millionths = lambda c: F.round(c * 1e6).cast("long").cast("string")
    points = F.array_join(F.transform("coords", lambda c: F.concat_ws(":", c["ts"].cast("long").cast("string"), millionths(c["lon"]), millionths(c["lat"]))), ",")
    return _objects(spark, sf, "traj").select("mmsi", "ts_start", "ts_end", F.size("coords").cast("long").alias("n_points"), points.alias("points"))


@query(f"with recursive {_MERGE} select mmsi, ts_start, ts_end from merged where {_VALID}")
def stops(spark, sf):
    return _objects(spark, sf, "stop").select("mmsi", "ts_start", "ts_end")


def _trajectories(spark, sf) -> DataFrame:
    """With ids; staged first, as dealing rows by ranges looks at them twice."""
    rows = _objects(spark, sf, "traj").select("mmsi", F.timestamp_seconds("ts_start").cast("timestamp_ntz").alias("ts_start"), F.timestamp_seconds("ts_end").cast("timestamp_ntz").alias("ts_end"), "coords")
    return number(staged(rows), "trajectory_id", ["mmsi", "ts_start", "ts_end"])


def _stops(spark, sf) -> DataFrame:
    rows = _objects(spark, sf, "stop").select("mmsi", F.timestamp_seconds("ts_start").cast("timestamp_ntz").alias("ts_start"), F.timestamp_seconds("ts_end").cast("timestamp_ntz").alias("ts_end"), "ring")
    return number(staged(rows), "stop_id", ["mmsi", "ts_start", "ts_end"])


@query(f"with recursive {_VISITS} select trajectory_id::integer as trajectory_id, mmsi, pos, cell_z21, ts_entry, ts_exit from visit")
def trajectory_cells(spark, sf):
    done = cells.trajectory_cells(_trajectories(spark, sf))
    return done.select("trajectory_id", "mmsi", "pos", "cell_z21", _epoch("ts_entry").alias("ts_entry"), _epoch("ts_exit").alias("ts_exit"))


def _firsts(zoom: int) -> str:
    bits = 2 * (21 - zoom)
    return f"z{zoom} as (select trajectory_id, count(*)::integer as n_z{zoom}, string_agg(cell::varchar, ',' order by pos) as cells_z{zoom} from (select trajectory_id, cell_z21 >> {bits} as cell, min(pos) as pos from visit group by 1, 2) group by 1)"


@query(f"with recursive {_VISITS}, {', '.join(_firsts(z) for z in (13, 17, 21))} select trajectory_id::integer as trajectory_id, mmsi, n_z13, n_z17, n_z21, cells_z13, cells_z17, cells_z21 from tr join z13 using (trajectory_id) join z17 using (trajectory_id) join z21 using (trajectory_id)")
def trajectory_cell_arrays(spark, sf):
    """The array form of trajectories at three zooms, with the number of cells and the cells written out."""
    a = cells.trajectory_arrays(_trajectories(spark, sf))
    columns = [(z, f"cellstring_z{z}") for z in (13, 17, 21)]
    return a.select("trajectory_id", "mmsi", *[F.size(c).alias(f"n_z{z}") for z, c in columns], *[F.array_join(F.col(c).cast("array<string>"), ",").alias(f"cells_z{z}") for z, c in columns])


@query()
def stop_cells(spark, sf):
    done = cells.stop_cells(_stops(spark, sf))
    return done.select("stop_id", "mmsi", _epoch("ts_start").alias("ts_start"), _epoch("ts_end").alias("ts_end"), "cell_z21")


@query(
    _passage_sql(21, f", {_VISITS}, pc as (select distinct name, {_morton('x', 'y')} as cell_z21 from w) select trajectory_id::integer as trajectory_id, name, count(distinct cell_z21) as n_cells, min(ts_entry) as first_entry, max(ts_exit) as last_exit from visit join pc using (cell_z21) group by 1, 2", [*reference.PASSAGES, *LINES]).replace(") , ", "), ")
)
def trajectory_passage_join(spark, sf):
    """Cells that trajectories share with the built-in passages and two lines that they cross, with first entry and last exit."""
    visits = cells.trajectory_cells(_trajectories(spark, sf))
    passages = reference.passages(spark, [*reference.PASSAGES, *LINES])
    done = cells.crossings(visits, cells.passage_cells(passages), "trajectory_id", "name")
    return done.select("trajectory_id", "name", "n_cells", _epoch("first_entry").alias("first_entry"), _epoch("last_exit").alias("last_exit"))


# ---- incremental ids ---------------------------------------------------------------------------------------------------


@query("select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_linenumber >= 4)")
def unconverted_ids(spark, sf):
    t = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    done = t("lineitem").filter("l_linenumber >= 4").select(F.col("l_orderkey").alias("o_orderkey"))
    return ingest.unconverted(t("orders").select("o_orderkey"), done, "o_orderkey")


@query("select o_custkey from orders except select c_custkey from customer where c_custkey % 3 = 0")
def id_except(spark, sf):
    t = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    return t("orders").select("o_custkey").subtract(t("customer").filter("c_custkey % 3 = 0").select("c_custkey"))


@query(f"with {POINTS_CTE}, h as (select min(epoch_ts) + 21600 as until from pts) select mmsi, count(*) as num_points from pts where mmsi not in (select mmsi from pts, h where epoch_ts < until and sog >= 1 union select mmsi from pts, h where epoch_ts < until and sog < 1) group by mmsi")
def processed_union(spark, sf):
    """Vessels that neither moved nor stopped in the first six hours, and so are still to be processed."""
    p = points_of(spark, sf)
    until = p.agg((F.min(F.col("epoch_ts").cast("long")) + 21600).alias("until"))
    early = p.join(F.broadcast(until), F.col("epoch_ts").cast("long") < F.col("until"))  # one row
    return ingest.unprocessed_vessels(p, early.filter("sog >= 1"), early.filter("sog < 1"))

