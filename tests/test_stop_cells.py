"""Cells of stops against cutting each outline to each tile of its bounding box."""

import math
from datetime import datetime

import numpy as np

from wakeline.operators import cells
from wakeline.plans import catalogue

ZOOM = 21
#: Shares of a tile below which a cut is nothing, and from which on it is something, in square degrees.
NOTHING, SOMETHING = 1e-17, 1e-15


def tile_of(lon, lat):
    n = 1 << ZOOM
    return math.floor((lon / 360 + 0.5) * n), math.floor((1 - math.asinh(math.tan(math.radians(lat))) / math.pi) / 2 * n)


def corner_of(x, y):
    n = 1 << ZOOM
    return x / n * 360 - 180, math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * y / n))))


def cell_of(x, y):
    return sum((x >> b & 1) << 2 * b | (y >> b & 1) << 2 * b + 1 for b in range(ZOOM))


def cut(ring, axis, limit, sign):
    """The part of a ring on one side of a line along an axis."""
    out = []
    for p, q in zip(ring, ring[1:] + ring[:1]):
        a, b = sign * (p[axis] - limit), sign * (q[axis] - limit)
        if a >= 0:
            out.append(p)
        if (a > 0 > b) or (a < 0 < b):
            t = a / (a - b)
            out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
    return out


def area(ring):
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1]))) / 2


def brute_force(ring):
    """Cells that hold something of the ring, and those whose share is too small to tell."""
    if ring[0] == ring[-1]:
        ring = ring[:-1]
    x0, y0 = ring[0]
    near = [(x - x0, y - y0) for x, y in ring]
    tiles = [tile_of(*p) for p in ring]
    sure, open_ = set(), set()
    for x in range(min(t[0] for t in tiles) - 1, max(t[0] for t in tiles) + 2):
        west, east = corner_of(x, 0)[0] - x0, corner_of(x + 1, 0)[0] - x0
        column = cut(cut(near, 0, west, 1), 0, east, -1)
        for y in range(min(t[1] for t in tiles) - 1, max(t[1] for t in tiles) + 2):
            north, south = corner_of(x, y)[1] - y0, corner_of(x, y + 1)[1] - y0
            share = area(cut(cut(column, 1, south, 1), 1, north, -1))
            if share >= SOMETHING:
                sure.add(cell_of(x, y))
            elif share > NOTHING:
                open_.add(cell_of(x, y))
    return sure, open_


def hold(rings, found):
    for key, ring in rings.items():
        sure, open_ = brute_force(ring)
        got = found.get(key, [])
        assert len(got) == len(set(got))
        assert sure <= set(got) <= sure | open_


def by_stop(df):
    out = {}
    for r in df.select("stop_id", "cell_z21").collect():
        out.setdefault(r.stop_id, []).append(r.cell_z21)
    return out


def test_jagged_outlines(spark):
    rng = np.random.default_rng(7)
    rings = {}
    for i in range(12):
        turn = np.sort(rng.uniform(0, 2 * math.pi, 5 + 3 * i))
        reach = rng.uniform(0.1, 1, len(turn)) * 1e-5 * 3 ** (i % 6)  # from parts of a cell to some thirty cells
        lon, lat = rng.uniform(-170, 170), rng.uniform(-70, 70)
        ring = [(float(lon + r * math.cos(t)), float(lat + r * math.sin(t))) for t, r in zip(turn, reach)]
        rings[i + 1] = [*ring, ring[0]]
    at = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [(i, 219000001, *at, [{"lon": x, "lat": y} for x, y in ring]) for i, ring in rings.items()]
    stops = spark.createDataFrame(rows, "stop_id int, mmsi long, ts_start timestamp_ntz, ts_end timestamp_ntz, ring array<struct<lon:double,lat:double>>")
    found = by_stop(cells.stop_cells(stops))
    hold(rings, found)
    assert max(len(c) for c in found.values()) > 100


def test_stops_of_the_made_up_vessels(spark, sf):
    rings = {r.stop_id: [(p.lon, p.lat) for p in r.ring] for r in catalogue._stops(spark, sf).collect()}
    found = by_stop(catalogue.QUERIES["stop_cells"](spark, sf))
    assert set(found) == set(rings)
    hold(rings, found)
