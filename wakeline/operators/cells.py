"""Cell tables of trajectories, stops, regions and passages, their array form, and joins on cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cover import cell_intervals, large_polygon_cover, line_cover, polygon_cover


def trajectory_cells(trajectories: DataFrame, zoom: int = 21) -> DataFrame:
    """trajectory_id, mmsi, ts_entry, ts_exit, cell_z21 and pos of each cell visit."""
    covered = line_cover(trajectories.select("trajectory_id", "mmsi", "ts_end", "coords"), "coords", zoom).drop("coords")
    return cell_intervals(covered).select("trajectory_id", "mmsi", "ts_entry", "ts_exit", "cell_z21", "pos")


def stop_cells(stops: DataFrame) -> DataFrame:
    """stop_id, mmsi, ts_start, ts_end, cell_z21 of each cell that a stop's polygon meets."""
    shapes = stops.withColumn("geom", F.array(F.array("ring"))).drop("ring")
    covered = polygon_cover(shapes, "geom")
    return covered.select("stop_id", "mmsi", "ts_start", "ts_end", F.explode("cells_z21").alias("cell_z21"))


def region_cells(regions: DataFrame, zoom: int = 21) -> DataFrame:
    """region_id, name and cell of each cell that a region meets, for regions of any size."""
    return large_polygon_cover(regions.select("region_id", "name", "geom"), "region_id", "geom", zoom).join(regions.select("region_id", "name"), "region_id").select("region_id", "name", F.col("cell").alias(f"cell_z{zoom}"))


def passage_cells(passages: DataFrame, zoom: int = 21) -> DataFrame:
    """passage_id, name and each distinct cell on a passage's line, with its place on it (pos)."""
    covered = line_cover(passages.select("passage_id", "name", "coords"), "coords", zoom)
    distinct = F.array_distinct(F.transform("cells", lambda c: c["cell"]))
    return covered.select("passage_id", "name", F.posexplode(distinct).alias("pos", f"cell_z{zoom}"))


def passage_arrays(passages: DataFrame) -> DataFrame:
    """One row a passage, its cells at zoom 13, 17 and 21 as arrays, each zoom walked by itself."""
    out = passages
    for zoom in (13, 17, 21):
        out = line_cover(out, "coords", zoom).withColumn(f"cellstring_z{zoom}", F.array_distinct(F.transform("cells", lambda c: c["cell"]))).drop("cells")
    return out.drop("coords")


def trajectory_arrays(trajectories: DataFrame, coarse: bool = True) -> DataFrame:
    """One row a trajectory, its distinct cells as arrays; the coarse ones derived from zoom 21, or empty."""
    covered = line_cover(trajectories, "coords", 21).withColumn("cellstring_z21", F.array_distinct(F.transform("cells", lambda c: c["cell"])))
    for zoom, bits in ((17, 8), (13, 16)):
        made = F.expr(f"array_distinct(transform(cellstring_z21, c -> shiftright(c, {bits})))") if coarse else F.expr("cast(array() as array<bigint>)")
        covered = covered.withColumn(f"cellstring_z{zoom}", made)
    return covered.select("trajectory_id", "mmsi", "ts_start", "ts_end", "cellstring_z13", "cellstring_z17", "cellstring_z21")


def polygon_arrays(shapes: DataFrame, geom: str = "geom", skip_z21: bool = False) -> DataFrame:
    """One row a shape, its cells as arrays."""
    out = polygon_cover(shapes, geom, skip_z21).drop(geom)
    return out.withColumnsRenamed({f"cells_z{z}": f"cellstring_z{z}" for z in (13, 17, 21)})


def to_arrays(rows: DataFrame, key: str, cell: str = "cell_z21", order: str | None = "pos") -> DataFrame:
    """Long rows as one array of distinct cells for each key, in order of first place or of the cell."""
    firsts = rows.groupBy(key, cell).agg(F.min(order if order else cell).alias("at"))
    return firsts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", F.col(cell).alias("c")))), lambda x: x["c"]).alias("cells"))


def join_cells(visits: DataFrame, places: DataFrame, place_key: str, cell: str = "cell_z21") -> DataFrame:
    """Visits in a place's cells: an equi-join on the cell. Spark splits skewed cells and prunes visits with a runtime
    filter on the places' cells."""
    return visits.join(places.select(place_key, cell), cell)


def join_cells_coarse(visits: DataFrame, places: DataFrame, place_key: str, cell: str = "cell_z21", bits: int = 16) -> DataFrame:
    """The same rows in two steps: visits whose coarse parent cell has no place go first, which is cheap where places are few."""
    parents = places.select(F.shiftright(cell, bits).alias("__parent")).distinct()
    near = visits.withColumn("__parent", F.shiftright(cell, bits)).join(parents, "__parent", "left_semi").drop("__parent")
    return join_cells(near, places, place_key, cell)


def crossings(visits: DataFrame, places: DataFrame, key: str, place_key: str) -> DataFrame:
    """For each object and place: cells, first entry and last exit."""
    return join_cells(visits, places, place_key).groupBy(key, place_key).agg(F.countDistinct("cell_z21").alias("n_cells"), F.min("ts_entry").alias("first_entry"), F.max("ts_exit").alias("last_exit"))
