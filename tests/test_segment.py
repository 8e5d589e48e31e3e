import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wakeline.config import Thresholds
from wakeline.operators import segment
from wakeline.operators.segment import Track

T0 = 1_700_000_000


def track(points):
    """points: (lon, lat, ts, sog or None)"""
    a = np.array([[p[0], p[1], math.nan if p[3] is None else p[3], p[2]] for p in points], float)
    return Track(*a.T)


def labels(points):
    return segment.fold(track(points))[2]


def metres_east(m, lat=55.0):
    return m / (segment.EARTH_RADIUS_M * math.cos(math.radians(lat)) * math.pi / 180)


def test_a_point_after_a_gap_does_not_bridge_two_countries():
    points = [(-1.0, 52, T0, 12.0), (-0.99, 52, T0 + 60, 12.0), (-0.98, 52, T0 + 7200, 12.0)]
    points += [(8.5 + 0.01 * i, 53.5, T0 + 7200 + 259200 + 60 * i, 12.0) for i in range(11)]
    t = track(points)
    moves, stops = segment.segment(t)
    assert len(moves) == 1 and not stops and len(moves[0]) == 11
    assert all(t.lon[i] > 8 for i in moves[0])


def test_coincident_points_without_speed_are_a_stop():
    t = track([(10.383365, 57.056374, T0 + 10 * i, None) for i in range(100)])
    moves, stops = segment.segment(t)
    assert not moves and len(stops) == 1
    assert (t.ts[stops[0][0]], t.ts[stops[0][-1]]) == (T0, T0 + 990)
    ring = segment.stop_ring(t, stops[0])
    assert ring[0] == ring[-1] and len(ring) == 65


def test_outliers_keep_the_point_before_and_leave_a_stop_open():
    p = [(10.0, 55.0, T0 + 60 * i, 0.1) for i in range(3)] + [(12.0, 55.0, T0 + 180, 30.0), (10.0, 55.0, T0 + 240, 0.1)]
    assert labels(p) == ["init", "stop", "stop", "outlier", "stop"]
    _, stays, _ = segment.fold(track(p))
    assert stays == [[0, 1, 2, 4]]


def test_equal_times_are_skipped():
    assert labels([(10, 55, T0, 5.0), (10, 55.001, T0, 5.0), (10, 55.002, T0 + 60, 5.0)]) == ["init", "dup", "move"]


def test_a_gap_ends_a_trajectory_and_its_point_starts_the_next():
    p = [(10 + 0.001 * i, 55, T0 + 60 * i, 5.0) for i in range(3)] + [(10.01, 55, T0 + 5000, 5.0), (10.011, 55, T0 + 5060, 5.0)]
    moves, _, marks = segment.fold(track(p))
    assert marks == ["init", "move", "move", "gap", "move"] and moves == [[0, 1, 2], [3, 4]]


@pytest.mark.parametrize(("apart", "joined"), [(49, 1), (51, 2)])
def test_stops_merge_below_fifty_metres(apart, joined):
    a = [(10.0, 55.0, T0 + 60 * i, 0.1) for i in range(5)]
    b = [(10.0 + metres_east(apart), 55.0, T0 + 1000 + 60 * i, 0.1) for i in range(5)]
    t = track(a + b)
    assert len(segment.merge_stops(t, [[0, 1, 2, 3, 4], [5, 6, 7, 8, 9]])) == joined


def test_stops_do_not_merge_after_an_hour():
    t = track([(10.0, 55.0, T0 + 60 * i + (3600 if i > 4 else 0), 0.1) for i in range(10)])
    assert len(segment.merge_stops(t, [[0, 1, 2, 3, 4], [5, 6, 7, 8, 9]])) == 2


def test_validity_by_shape():
    spread = lambda dx, dy: track([(10 + dx * (i % 4), 55 + dy * (i % 3), T0 + 100 * i, 0.1) for i in range(12)])
    every = list(range(12))
    assert segment.is_stop(spread(0, 0), every)
    assert not segment.is_stop(spread(1e-5, 0), every)
    assert not segment.is_stop(spread(0, 1e-5), every)
    assert segment.is_stop(spread(1e-5, 1e-5), every)
    assert not segment.is_stop(spread(0.05, 0.05), every)
    assert not segment.is_stop(spread(0, 0), every[:9])
    assert not segment.is_stop(spread(0, 0), every, Thresholds(stop_duration_s=1101))
    diagonal = track([(10 + 1e-5 * i, 55 + 1e-5 * i, T0 + 100 * i, 0.1) for i in range(12)])
    assert segment.is_stop(diagonal, every)
    ring = segment.stop_ring(diagonal, every)
    assert len(ring) >= 4 and ring[0] == ring[-1]


def slow(n, start=0):
    return track([(10 + 1e-4 * i, 55, T0 + 60 * (start + i), 0.1) for i in range(n)])


def test_each_fate_of_an_invalid_stop():
    t = slow(12)
    moves = [[0, 1, 2], [5, 6, 7]]
    assert segment.absorb(t, [2, 3, 4, 5], moves) == "bridge" and moves == [[0, 1, 2, 2, 3, 4, 5, 5, 6, 7]]
    moves = [[0, 1, 2]]
    assert segment.absorb(t, [2, 3, 4], moves) == "append" and moves == [[0, 1, 2, 2, 3, 4]]
    moves = [[5, 6, 7]]
    assert segment.absorb(t, [3, 4, 5], moves) == "prepend" and moves == [[3, 4, 5, 5, 6, 7]]
    moves = []
    assert segment.absorb(t, list(range(10)), moves) == "new" and moves == [list(range(10))]
    assert segment.absorb(t, [0, 1], moves) == "drop"
    moves = [[5, 6, 7], [0, 1, 2]]
    assert segment.absorb(t, [2, 3, 4, 5], moves) == "bridge" and moves == [[0, 1, 2, 2, 3, 4, 5, 5, 6, 7]]
    late = track([(10, 55, T0, 0.1), (10, 55, T0 + 3601, 0.1)])
    assert segment.absorb(late, [0, 1], []) == "discard"


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40), st.integers(0, 4000), st.one_of(st.none(), st.floats(0, 20))), min_size=1, max_size=40))
def test_segments_follow_time_and_share_ends(steps):
    now, points = T0, []
    for x, y, dt, sog in steps:
        now += dt
        points.append((10 + x * 1e-3, 55 + y * 1e-3, now, sog))
    t = track(points)
    moves, stays, marks = segment.fold(t)
    assert len(marks) == len(points) and marks[0] == "init"
    for part in [*moves, *stays]:
        assert len(part) > 1 and part == sorted(part)
    done, stops = segment.segment(t)
    assert all(t.ts[m[-1]] > t.ts[m[0]] and len(m) >= 10 for m in done)
    assert all(segment.is_stop(t, s) for s in stops)


def test_objects_of_a_table(spark):
    rows = [(219000001, 57.056374, 10.383365, None, T0 + 10.0 * i) for i in range(100)] + [(219000002, 55.0, 10.0, 0.0, float(T0))]
    df = spark.createDataFrame(rows, "mmsi long, lat double, lon double, sog double, epoch_ts double").withColumn("timestamp", F.timestamp_seconds("epoch_ts").cast("timestamp_ntz"))
    out = segment.objects(df).collect()
    assert [(r.mmsi, r.kind, r.ts_start, r.ts_end, len(r.ring)) for r in out] == [(219000001, "stop", T0, T0 + 990, 65)]
    assert segment.objects(df.limit(0)).count() == 0
    assert {r.label for r in segment.point_labels(df).collect()} == {"init", "stop"}


def test_a_vessel_day_that_raises_is_kept_as_a_row_on_request(spark):
    rows = [(219000001, 57.056374, 10.383365, None, T0 + 10.0 * i) for i in range(100)] + [(219000002, 55.0, 10 + 0.01 * i, 20.0, T0 + 30.0 * i) for i in range(30)]
    df = spark.createDataFrame(rows, "mmsi long, lat double, lon double, sog double, epoch_ts double").withColumn("timestamp", F.timestamp_seconds("epoch_ts").cast("timestamp_ntz"))
    broken = Thresholds(stop_points="ten")  # only a vessel that stops compares with it
    with pytest.raises(Exception, match="TypeError"):
        segment.objects(df, broken).collect()
    out = {r.mmsi: r for r in segment.objects(df, broken, keep_errors=True).collect()}
    assert (out[219000001].kind, out[219000001].ts_start, out[219000001].ts_end, out[219000001].coords) == ("error", T0, T0 + 990, None)
    assert "TypeError" in out[219000001].error
    assert out[219000002].kind == "traj" and out[219000002].error is None


def test_midnight_cuts_unless_told_otherwise(spark):
    start = 1_700_006_400 - 300  # five minutes before midnight
    rows = [(219000001, 55.0, 10 + 0.01 * i, 20.0, float(start + 30 * i)) for i in range(30)]
    df = spark.createDataFrame(rows, "mmsi long, lat double, lon double, sog double, epoch_ts double").withColumn("timestamp", F.timestamp_seconds("epoch_ts").cast("timestamp_ntz"))
    assert sorted(len(r.coords) for r in segment.objects(df).collect()) == [10, 20]
    assert [len(r.coords) for r in segment.objects(df, by_day=False).collect()] == [30]
