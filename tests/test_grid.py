import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wakeline.functions import geo, grid, hull
from wakeline.operators import cells, cover
from wakeline.sources import reference
from wakeline.sources.geojson import regions

# A ring and the ids of all z21 cells that it meets, columns first.
RING = [
    (10.788898468017578, 57.37221145629883), (10.787409782409668, 57.37289810180664), (10.787253379821777, 57.37300491333008), (10.786907196044922, 57.37324905395508),
    (10.786700248718262, 57.37343215942383), (10.786727905273438, 57.37344741821289), (10.78807258605957, 57.373050689697266), (10.788095474243164, 57.373043060302734),
    (10.788132667541504, 57.373023986816406), (10.788783073425293, 57.37237548828125), (10.78880500793457, 57.372352600097656), (10.788829803466797, 57.37232208251953),
    (10.788851737976074, 57.372291564941406), (10.7888765335083, 57.37225341796875), (10.788898468017578, 57.37221145629883),
]
RING_CELLS = [
    1661610825011, 1661610825017, 1661610825014, 1661610825020, 1661610825022, 1661610825108, 1661610825021, 1661610825023, 1661610825109, 1661610825111,
    1661610825064, 1661610825066, 1661610825152, 1661610825154, 1661610825160, 1661610825067, 1661610825153, 1661610825155, 1661610825161, 1661610825163,
    1661610825070, 1661610825156, 1661610825158, 1661610825164, 1661610825166, 1661610825188, 1661610825157, 1661610825159, 1661610825165, 1661610825167,
    1661610825189, 1661610825191, 1661610825170, 1661610825176, 1661610825178, 1661610825200, 1661610825202, 1661610825208, 1661610825171, 1661610825177,
    1661610825179, 1661610825201, 1661610825203, 1661610825209, 1661610825211, 1661610825180, 1661610825182, 1661610825204, 1661610825206, 1661610825212,
    1661610825214, 1661610825556, 1661610825205, 1661610825207, 1661610825213, 1661610825215, 1661610825557, 1661610825559, 1661610836136, 1661610836138,
    1661610836480, 1661610836482, 1661610836481, 1661610836483, 1661610836489,
]
# A concave ring, and numbers of cells at zoom 13, 17 and 21.
CONCAVE = [
    (10.314142022338359, 56.989841283038544), (10.308192009866758, 56.96758619876718), (10.32171476548396, 56.97466210465393), (10.339564802898877, 56.97525170280585),
    (10.343892084696563, 56.969650143499706), (10.324419316607646, 56.9565274047078), (10.341457988686244, 56.94753049842973), (10.36390576301099, 56.96729134018483),
    (10.378510339077962, 56.99617639075896), (10.353087558517444, 56.99882797615109), (10.347137546045786, 56.99043064087442), (10.336860251775192, 56.97878909571352),
    (10.32766477795559, 56.97937862853158), (10.327935233067706, 56.98880988437111), (10.314142022338359, 56.989841283038544),
]
# Distinct cells of the passages at zoom 13, 17 and 21, and of the small regions.
PASSAGE_COUNTS = {"Skagen": (28, 438, 6999), "Kiel": (12, 167, 2641), "Storebælt Nord": (8, 105, 1669), "Storebælt Syd": (9, 131, 2064), "Sundet Nord": (12, 173, 2759), "Sundet Syd": (13, 187, 2984),
                  "Bornholms Gate": (21, 305, 4858), "Kadetrenden": (18, 275, 4392), "Fynshoved": (7, 99, 1570), "Lillebælt Nord": (6, 85, 1326), "Lillebælt Syd": (13, 194, 3099), "Bornholm Syd": (23, 355, 5658)}


def line(coords, zoom=21):
    ts = [c[2] for c in coords] if len(coords[0]) > 2 else None
    found, entry = grid.line_cells([c[0] for c in coords], [c[1] for c in coords], ts, zoom)
    return list(zip(found.tolist(), entry.tolist()))


def test_polygon_cells_of_a_known_ring_come_columns_first():
    assert grid.flat_cover([[RING]], 21).tolist() == RING_CELLS


def test_stepwise_cover_equals_the_flat_one():
    got = grid.polygon_cells([[CONCAVE]])
    assert [len(x) for x in got] == [7, 460, 98582]
    for zoom, found in zip((13, 17), got):
        assert set(found.tolist()) == set(grid.flat_cover([[CONCAVE]], zoom).tolist())
    assert set(got[2].tolist()) == set(grid.flat_cover([[CONCAVE]], 21).tolist())
    assert [len(x) for x in grid.polygon_cells([[CONCAVE]], skip_z21=True)] == [7, 460, 0]
    assert [len(x) for x in grid.polygon_cells([])] == [0, 0, 0]


def test_tiles_in_and_out_of_a_square():
    shape = grid.Shape([[[(10, 57), (11, 57), (11, 58), (10, 58)]]])
    for lon, lat, kind in ((10.5, 57.5, grid.FULL), (15, 60, grid.NONE), (10.0, 57.5, grid.PARTIAL)):
        x, y = grid.fractions(np.array([lon]), np.array([lat]), 13)
        assert shape.classify(*grid.tile_box(np.floor(x), np.floor(y), 13))[0] == kind


def test_a_hole_is_outside():
    outer, inner = [(10, 57), (11, 57), (11, 58), (10, 58)], [(10.3, 57.3), (10.7, 57.3), (10.7, 57.7), (10.3, 57.7)]
    x, y = (np.floor(v) for v in grid.fractions(np.array([10.5]), np.array([57.5]), 13))
    assert grid.Shape([[outer, inner]]).classify(*grid.tile_box(x, y, 13))[0] == grid.NONE


def test_lines():
    assert grid.line_cells([], [])[0].size == 0
    assert len(line([(10.0, 55.0), (10.0000001, 55.0000001)])) == 1
    assert line([(10.0, 55.0, 1000), (10.0000001, 55.0000001, 1010), (10.0000002, 55.0000002, 1020)])[0][1] == 1000
    assert [t for _, t in line([(10.0, 55.0, 1000 + 10 * i) for i in range(4)])] == [1000]
    there_and_back = [(10.0, 55.0, 1000), (10.00001, 55.00001, 1005), (10.00002, 55.00002, 1010), (10.0003, 55.0, 1020), (10.0003, 55.0, 1030), (10.0, 55.0, 1040), (10.00001, 55.00001, 1045)]
    assert line(there_and_back) == [(1685081506548, 1000), (1685081506549, 1020), (1685081506548, 1040)]
    eight = [(10.0, 55.0, 1000), (10.1, 55.1, 1010), (10.2, 55.0, 1020), (10.1, 54.9, 1030), (10.0, 55.0, 1040)]
    found = line(eight, 13)
    assert (len(found), len({c for c, _ in found})) == (27, 25)
    assert [len(line([(10.0, 55.0, 1000), (10.1, 55.1, 1010)], z)) for z in (21, 17, 13)] == [1600, 101, 7]
    assert line([(10.0, 90.0, 0), (11.0, 90.0, 5)]) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(9.9, 10.1), st.floats(54.95, 55.05), st.integers(0, 10_000)), min_size=2, max_size=6))
def test_line_cells_are_neighbours_and_times_rise(coords):
    coords = sorted(coords, key=lambda c: c[2])
    found = line(coords, 15)
    assert found
    xy = [tuple(int(v) for v in grid.unmorton(np.array(c))) for c, _ in found]
    for (x0, y0), (x1, y1) in zip(xy, xy[1:]):
        assert (x0, y0) != (x1, y1)
        assert abs(x0 - x1) + abs(y0 - y1) <= 2
    times = np.array([t for _, t in found])
    assert (np.diff(times) >= 0).all()
    assert (grid.exit_times(times, coords[-1][2]) >= times).all()


def test_exit_times_with_ties():
    assert grid.exit_times(np.array([5, 5, 9]), 8).tolist() == [5, 9, 9]
    assert grid.exit_times(np.array([], np.int64), 8).tolist() == []


def test_column_expressions(spark):
    places = [(10.383365, 57.056374, 111090630641880), (8.614294, 56.550693, 110987570647260), (-123.120231, 49.290563, 103313480717620), (-57.853151, -34.469250, 107115561262712), (144.944281, -37.815050, 118929371286854)]
    df = spark.createDataFrame(places, "lon double, lat double, cell long")
    lon, lat = F.col("lon"), F.col("lat")
    rows = df.select("*", geo.decimal_lonlat_cell(lon, lat).alias("decimal"), geo.tile_x(lon, 21).alias("x"), geo.tile_y(lat, 21).alias("y"), geo.lonlat_cell(lon, lat, 21).alias("id")).collect()
    back = df.select(geo.decimal_cell_x(F.col("cell"), 21).alias("x"), geo.decimal_cell_y(F.col("cell"), 21).alias("y"), geo.cell_x(geo.lonlat_cell(lon, lat, 21)).alias("mx"), geo.cell_y(geo.lonlat_cell(lon, lat, 21)).alias("my")).collect()
    for r, b in zip(rows, back):
        assert r.decimal == r.cell and (b.x, b.y) == (r.x, r.y) == (b.mx, b.my)
        assert r.id == int(grid.morton(np.array(r.x), np.array(r.y)))
    one = spark.range(1)
    assert one.select(geo.tile_fraction_y(F.lit(90.0), 21)).first()[0] is None
    assert one.select(geo.speed_kn(F.lit(10.0), F.lit(0.0))).first()[0] == math.inf
    assert one.select(geo.child_cells(F.lit(5).cast("long"), 13, 14)).first()[0] == [20, 21, 22, 23]
    assert one.select(geo.child_cells(F.lit(5).cast("long"), 13, 13)).first()[0] == [5]
    assert one.select(geo.decimal_cell(F.lit(3), F.lit(4), 13)).first()[0] == 100_030_004


def test_line_cover_and_intervals(spark):
    coords = [{"lon": a, "lat": b, "ts": float(t)} for a, b, t in ((10.0, 55.0, 1000), (10.0003, 55.0, 1020), (10.0, 55.0, 1040))]
    df = spark.createDataFrame([(1, coords), (2, [])], "id int, coords array<struct<lon:double,lat:double,ts:double>>")
    done = cover.line_cover(df.withColumn("ts_end", F.timestamp_seconds(F.lit(1050)).cast("timestamp_ntz")))
    rows = cover.cell_intervals(done.drop("coords")).orderBy("pos").collect()
    assert [(r.id, r.ts_entry.second + 60 * r.ts_entry.minute, r.ts_exit.second + 60 * r.ts_exit.minute) for r in rows] == [(1, 1000, 1020), (1, 1020, 1040), (1, 1040, 1050)]
    assert [len(r.cell_ids) for r in cover.line_cell_ids(df).orderBy("id").collect()] == [2, 0]


def test_passages_and_small_regions(spark):
    counts = {r.name: tuple(len(r[f"cellstring_z{z}"]) for z in (13, 17, 21)) for r in cells.passage_arrays(reference.passages(spark)).collect()}
    assert counts == PASSAGE_COUNTS
    small = reference.region_polygons(spark).filter("name like 'small%'")
    by_rows = {r.name: r["n"] for r in cells.region_cells(small, 21).groupBy("name").agg(F.count_distinct("cell_z21").alias("n")).collect()}
    assert by_rows == {"small_region_high_traffic": 10388, "small_region_low_traffic": 10176}
    whole = cells.polygon_arrays(small).collect()
    assert {r.name: tuple(len(r[f"cellstring_z{z}"]) for z in (13, 17, 21)) for r in whole} == {"small_region_high_traffic": (1, 49, 10388), "small_region_low_traffic": (1, 56, 10176)}


def test_large_cover_equals_the_one_row_cover(spark):
    shapes = regions(spark, [(1, "ring", [[CONCAVE]])])
    rows = cover.large_polygon_cover(shapes, "region_id", to_zoom=21).select("cell").collect()
    assert len(rows) == 98582
    assert {r.cell for r in rows} == set(grid.polygon_cells([[CONCAVE]])[2].tolist())


def test_cell_joins_agree(spark):
    visits = cells.passage_cells(reference.passages(spark), 21).select("passage_id", "cell_z21")
    places = spark.createDataFrame([(c, "x") for c in [r.cell_z21 for r in visits.filter("passage_id = 3").limit(50).collect()]], "cell_z21 long, place string")
    a = sorted(map(tuple, cells.join_cells(visits, places, "place").collect()))
    assert a and a == sorted(map(tuple, cells.join_cells_coarse(visits, places, "place").collect()))


def test_hulls():
    square = [(x / 4, y / 4) for x in range(5) for y in range(5)]
    assert len(hull.convex_hull(square)) == 4
    assert hull.convex_hull([(0, 0), (1, 1), (2, 2)]) == [(0, 0), (2, 2)]
    u = [(x, y) for x in range(9) for y in range(9) if x in (0, 1) or x in (7, 8) or y in (0, 1)]
    u = [(x + 0.01 * math.sin(7 * x + y), y + 0.01 * math.cos(3 * x + 5 * y)) for x, y in u]
    ring = hull.concave_hull(u, 0.2)
    area = lambda r: abs(sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(r, [*r[1:], r[0]]))) / 2
    assert area(ring) < 0.7 * area(hull.convex_hull(u))
    shape = grid.Shape([[ring]])
    for x, y in u:
        e = 1e-9
        assert shape.classify(np.array([x - e]), np.array([y - e]), np.array([x + e]), np.array([y + e]))[0] > grid.NONE


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1, width=32), st.floats(0, 1, width=32)), min_size=3, max_size=40))
def test_concave_hulls_hold_all_points(points):
    ring = hull.concave_hull(points, 0.2)
    if len(hull.convex_hull(points)) < 3:
        return
    assert set(ring) <= {tuple(p) for p in points}
    shape = grid.Shape([[ring]])
    for x, y in points:
        e = 1e-6
        assert shape.classify(np.array([x - e]), np.array([y - e]), np.array([x + e]), np.array([y + e]))[0] > grid.NONE


@pytest.mark.parametrize("seed", range(3))
def test_delaunay_triangles_are_empty(seed):
    points = [tuple(p) for p in np.random.default_rng(seed).random((60, 2)).tolist()]
    triangles = hull.delaunay(points)
    assert len(triangles) == 2 * len(points) - 2 - len(hull.convex_hull(points))
    for t in triangles:
        (ax, ay), (bx, by), (cx, cy) = (points[i] for i in t)
        d = 2 * (ax * (by - cy) + bx * (cy - ay) + cx * (ay - by))
        ux = ((ax**2 + ay**2) * (by - cy) + (bx**2 + by**2) * (cy - ay) + (cx**2 + cy**2) * (ay - by)) / d
        uy = ((ax**2 + ay**2) * (cx - bx) + (bx**2 + by**2) * (ax - cx) + (cx**2 + cy**2) * (bx - ax)) / d
        r = math.dist((ux, uy), (ax, ay))
        assert all(math.dist((ux, uy), p) > r - 1e-9 for p in points)
