"""Cell covers of lines and polygons in DataFrames."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions import grid
from wakeline.sources.store import staged

#: Open cells of a task, bytes of all shapes up to which they are broadcast, and shapes that a task keeps.
CELLS_A_TASK, SHAPE_BYTES, KEPT_SHAPES = 256, 32 << 20, 1000
_PAIR = "array<struct<cell:bigint,ts:bigint>>"


def _coords(column: pa.Array):
    """Vertices of each line: views of the flat columns."""
    bounds = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())])
    flat = column.flatten()
    fields = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(flat.type.num_fields)]
    return [[f[a:b] for f in fields] for a, b in zip(bounds[:-1], bounds[1:])]


def _map(df: DataFrame, column: str, outputs: str, work) -> DataFrame:
    """df with the columns that work makes of one of its columns; the others pass through."""
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
    at = df.columns.index(column)

    def run(batches):
        for whole in batches:
            for lo in range(0, len(whole), 64):
                batch = whole.slice(lo, 64)
                made = work(batch.column(at))
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *(f"made{i}" for i in range(len(made)))])

    return df.mapInArrow(run, ", ".join([*kinds, outputs]))


def line_cover(lines: DataFrame, coords: str = "coords", zoom: int = 21) -> DataFrame:
    """lines with cells: an array of (cell, ts) in the order of the line; empty for a line of fewer than two vertices.

    coords is an array of (lon, lat) or (lon, lat, ts); without ts all times are 0. One line is one row, so this needs
    no shuffle whatever the lines' number."""

    def work(column):
        got = [grid.line_cells(*c[:2], c[2] if len(c) > 2 else None, zoom) for c in _coords(column)]
        ends = np.concatenate([[0], np.cumsum([len(c) for c, _ in got])]).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *(g[i] for g in got)])) for i in (0, 1)], ["cell", "ts"])
        return [pa.ListArray.from_arrays(pa.array(ends), pairs)]

    return _map(lines, coords, f"cells {_PAIR}", work)


def line_cell_ids(lines: DataFrame, coords: str = "coords", zoom: int = 21) -> DataFrame:
    """lines with cell_ids: the distinct cells of each, in the order of the first visit."""
    covered = line_cover(lines, coords, zoom)
    return covered.withColumn("cell_ids", F.array_distinct(F.transform("cells", lambda c: c["cell"]))).drop("cells")


def cell_intervals(covered: DataFrame, end: str = "ts_end") -> DataFrame:
    """One row for each cell of a line: pos, cell_z21, ts_entry and ts_exit. The next cell's entry is at hand in the array,
    so that no window and no shuffle is needed. end is the line's end as a timestamp."""
    seconds = F.expr(f"unix_seconds(cast(`{end}` as timestamp))")
    entries = F.transform("cells", lambda c: c["ts"])
    exits = F.concat(F.slice(entries, F.lit(2), F.greatest(F.size(entries) - 1, F.lit(0))), F.array(seconds))
    rows = covered.withColumn("__exits", exits).select(*[c for c in covered.columns if c != "cells"], "__exits", F.posexplode("cells").alias("pos", "__c"))
    left = F.greatest(F.col("__c.ts"), F.element_at("__exits", F.col("pos") + 1))
    stamp = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    return rows.withColumns({"cell_z21": F.col("__c.cell"), "ts_entry": stamp(F.col("__c.ts")), "ts_exit": stamp(left)}).drop("__exits", "__c")


def polygon_cover(shapes: DataFrame, geom: str = "geom", skip_z21: bool = False) -> DataFrame:
    """shapes with cells_z13, cells_z17 and cells_z21 (empty if skipped): the cells that each shape meets.

    geom is an array of polygons, each an array of rings of (lon, lat). Zoom by zoom only open cells are looked at; the
    cells inside are ranges. Right for shapes whose cells fit in a row; large_polygon_cover is for any size."""

    def work(column):
        got = [grid.polygon_cells(_shape(x), skip_z21) for x in column.to_pylist()]
        return [grid.lists([g[i] for g in got]) for i in range(3)]

    return _map(shapes, geom, ", ".join(f"cells_z{z} array<bigint>" for z in (13, 17, 21)), work)


def _shape(value) -> list:
    return [[[(p["lon"], p["lat"]) for p in ring] for ring in rings] for rings in value or []]


def large_polygon_cover(shapes: DataFrame, key: str, geom: str = "geom", to_zoom: int = 21) -> DataFrame:
    """key, cell, kind ('full' or 'partial') of each shape's cells at zoom 13, 17 or 21, one row a cell.

    Each zoom is a step of its own: the open cells are written, dealt over the cluster again by shape and cell, and split
    where they land; cells inside are sequences that the JVM explodes. A row is a key and a cell. The shapes go to the tasks by
    a broadcast, if their vertices prove it small, else along with the cells. No row ever holds more than one cell's descendants,
    so regions of any size pass. Keys tell shapes apart."""
    if to_zoom not in (13, 17, 21):
        raise ValueError("to_zoom is 13, 17 or 21")

    def first(column):
        got = []
        for value in column.to_pylist():
            shape = grid.Shape(_shape(value))
            if shape.empty:
                got.append((np.zeros(0, np.int64),) * 2)
                continue
            x, y = grid.box_tiles(shape, 13)
            kind, cells = shape.classify(*grid.tile_box(x, y, 13)), grid.morton(x, y)
            got.append((cells[kind == grid.FULL], cells[kind == grid.PARTIAL]))
        return [grid.lists([g[i] for g in got]) for i in (0, 1)]

    base = shapes.select(F.col(key), F.col(geom).alias("__geom"))
    vertices = "aggregate(__geom, 0L, (a, p) -> a + aggregate(p, 0L, (b, r) -> b + size(r)))"
    size = base.agg(F.coalesce(F.sum(F.expr(vertices)), F.lit(0)) * 24 + F.count("*") * 64).first()[0]
    found = staged(_map(base, "__geom", "full array<bigint>, partial array<bigint>", first).select(key, "full", "partial"))
    full, partial, zoom = found.select(key, F.explode("full").alias("cell")), found.select(key, F.explode("partial").alias("cell")), 13
    while zoom < to_zoom:
        grown = full.select(key, F.explode(F.expr("sequence(shiftleft(cell, 8), shiftleft(cell, 8) + 255)")).alias("cell"))
        tasks = max(base.sparkSession.sparkContext.defaultParallelism, partial.count() // CELLS_A_TASK)
        if size <= SHAPE_BYTES:
            dealt = partial.repartition(tasks, key, "cell").join(F.broadcast(base), key)
        else:
            dealt = partial.join(base, key).repartition(tasks, key, "cell")
        split = staged(_split(dealt.select(key, "cell", "__geom"), zoom))
        full, partial, zoom = grown.unionAll(split.select(key, F.explode("full").alias("cell"))), split.select(key, F.explode("partial").alias("cell")), zoom + 4
    return full.select(key, "cell", F.lit("full").alias("kind")).unionAll(partial.select(key, "cell", F.lit("partial").alias("kind")))


def _split(dealt: DataFrame, zoom: int) -> DataFrame:
    """Of each open cell (key, cell, shape) the cells four zooms deeper that lie inside, and those that are open."""
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema[:2]]

    def run(batches):
        known: dict = {}
        for batch in batches:
            full, left = [], []
            for i, (key, cell) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if key not in known:
                    if len(known) >= KEPT_SHAPES:
                        known.clear()
                    known[key] = grid.Shape(_shape(batch.column(2)[i].as_py()))
                a, b = grid.split_cells(known[key], zoom, np.zeros(0, np.int64), np.array([cell]), zoom + 4)
                full.append(a)
                left.append(b)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], grid.lists(full), grid.lists(left)], [*batch.schema.names[:2], "full", "partial"])

    return dealt.mapInArrow(run, ", ".join([*kinds, "full array<bigint>, partial array<bigint>"]))


def flat_polygon_cover(shapes: DataFrame, zoom: int, geom: str = "geom") -> DataFrame:
    """shapes with cells: the cells of one zoom that each shape meets, columns first (the older, flat cover)."""
    return _map(shapes, geom, "cells array<bigint>", lambda column: [grid.lists([grid.flat_cover(_shape(x), zoom) for x in column.to_pylist()])])


def classify_tiles(shapes: DataFrame, geom: str, x: str, y: str, zoom: int) -> DataFrame:
    """shapes with kind: 2 where the tile (x, y) lies in the shape, 1 where they meet, 0 where they do not."""
    base = shapes.withColumn("__tile", F.struct(F.col(geom).alias("g"), F.col(x).cast("long").alias("x"), F.col(y).cast("long").alias("y")))

    def work(column):
        rows = column.to_pylist()
        return [pa.array([int(grid.Shape(_shape(r["g"])).classify(*grid.tile_box(np.array([r["x"]]), np.array([r["y"]]), zoom))[0]) if r["g"] else 0 for r in rows], pa.int32())]

    return _map(base, "__tile", "kind int", work).drop("__tile")
