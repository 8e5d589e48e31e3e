"""Trajectories and stops of vessels.

What comes before a point in the fold depends on the data (points with the time of the one before and outliers do not
move it), so a vessel's points of a day are folded in order in one grouped Arrow function; whatever is not sequential
stays outside. Vessel-days are many and small; a vessel-day is what a task has to hold.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wakeline.config import Thresholds
from wakeline.functions import hull
from wakeline.functions.geo import EARTH_RADIUS_M, KNOT_MPS, mbr_area_m2

LIMITS = Thresholds()
OBJECTS = "mmsi long, kind string, seq int, ts_start long, ts_end long, coords array<struct<lon:double,lat:double,ts:double>>, ring array<struct<lon:double,lat:double>>, error string"


def distance_m(lon1, lat1, lon2, lat2):
    """Great-circle distance in metres of numbers or arrays in degrees."""
    p1, p2 = np.radians(lat1), np.radians(lat2)
    dp, dl = np.sin((p2 - p1) / 2), np.sin((np.radians(lon2) - np.radians(lon1)) / 2)
    return EARTH_RADIUS_M * 2 * np.arcsin(np.sqrt(dp * dp + np.cos(p1) * np.cos(p2) * dl * dl))


@dataclass
class Track:
    """Points of one vessel in order of time; sog is nan where it is unknown."""

    lon: np.ndarray
    lat: np.ndarray
    sog: np.ndarray
    ts: np.ndarray

    def __post_init__(self) -> None:
        # Plain numbers: the fold looks at one point at a time.
        self.x, self.y, self.t = self.lon.tolist(), self.lat.tolist(), self.ts.tolist()
        self.step = distance_m(self.lon[:-1], self.lat[:-1], self.lon[1:], self.lat[1:]).tolist()

    def motion(self, i: int, j: int) -> tuple[float, float, float]:
        """Seconds, metres and knots from point i to point j."""
        seconds = self.t[j] - self.t[i]
        metres = self.step[i] if j == i + 1 else float(distance_m(self.x[i], self.y[i], self.x[j], self.y[j]))
        return seconds, metres, metres / seconds / KNOT_MPS if seconds > 0 else math.inf

    def at(self, i: int) -> tuple[float, float, float]:
        return self.x[i], self.y[i], self.t[i]


class _Open:
    """A segment that is being built, and those of its kind that are finished."""

    def __init__(self) -> None:
        self.now: list[int] = []
        self.done: list[list[int]] = []

    def join(self, before: int) -> None:
        if not self.now:
            self.now.append(before)

    def close(self) -> None:
        if len(self.now) > 1:
            self.done.append(self.now)
        self.now = []


def fold(track: Track, limits: Thresholds = LIMITS) -> tuple[list[list[int]], list[list[int]], list[str]]:
    """Candidate trajectories and stops as lists of point numbers, and what each point was taken for."""
    moves, stays, labels = _Open(), _Open(), []
    before, times = -1, track.t
    for i, sog in enumerate(track.sog.tolist()):
        if before < 0:
            (stays if math.isnan(sog) or sog < limits.stop_sog_kn else moves).now.append(i)
            labels.append("init")
            before = i
            continue
        if times[i] == times[before]:
            labels.append("dup")
            continue
        seconds, metres, knots = track.motion(before, i)
        if (knots if math.isnan(sog) else sog) < limits.stop_sog_kn and seconds < limits.stop_gap_s and metres < limits.stop_distance_m:
            stays.join(before)
            stays.now.append(i)
            moves.close()
            labels.append("stop")
        else:
            moves.join(before)
            if knots >= limits.traj_speed_kn:
                labels.append("outlier")
                continue
            if seconds < limits.traj_gap_s:
                moves.now.append(i)
                labels.append("move")
            else:
                moves.close()
                labels.append("gap")
            stays.close()
        before = i
    moves.close()
    stays.close()
    return moves.done, stays.done, labels


def merge_stops(track: Track, stops: list[list[int]], limits: Thresholds = LIMITS) -> list[list[int]]:
    """Stops joined to what has been joined so far where the pause is short and the mean positions are near."""
    out: list[list[int]] = []
    east = north = 0.0
    for stop in stops:
        e, n = sum(track.x[i] for i in stop), sum(track.y[i] for i in stop)
        if out:
            last = out[-1]
            near = distance_m(east / len(last), north / len(last), e / len(stop), n / len(stop)) < limits.merge_distance_m
            if near and track.t[stop[0]] - track.t[last[-1]] < limits.merge_gap_s:
                out[-1] = last + stop
                east, north = east + e, north + n
                continue
        out.append(list(stop))
        east, north = e, n
    return out


def is_stop(track: Track, stop: list[int], limits: Thresholds = LIMITS) -> bool:
    """Enough points and time, and an extent that is a point, or an area that is not too large (not a line along an axis)."""
    if len(stop) < limits.stop_points or int(track.ts[stop[-1]]) - int(track.ts[stop[0]]) < limits.stop_duration_s:
        return False
    w, s, e, n = _bounds(track, stop)
    if w == e and s == n:
        return True
    if w == e or s == n:
        return False
    return distance_m(w, s, e, s) * distance_m(w, s, w, n) <= limits.stop_area_m2


def _bounds(track: Track, at: list[int]):
    lon, lat = track.lon[at], track.lat[at]
    return lon.min(), lat.min(), lon.max(), lat.max()


def stop_ring(track: Track, stop: list[int], limits: Thresholds = LIMITS) -> list[tuple[float, float]]:
    """The closed ring around a valid stop: concave hull, else the box, else a small circle."""
    w, s, e, n = (float(x) for x in _bounds(track, stop))
    if w == e and s == n:
        ring = hull.around(w, s, limits.point_buffer_deg)
    else:
        ring = hull.concave_hull(list(zip(track.lon[stop].tolist(), track.lat[stop].tolist())), limits.hull_ratio)
        if len(ring) < 3:
            ring = [(w, s), (e, s), (e, n), (w, n)]
    return [*ring, ring[0]]


def absorb(track: Track, stop: list[int], moves: list[list[int]], limits: Thresholds = LIMITS) -> str:
    """What becomes of a stop that is not valid: it bridges, lengthens or starts trajectories in moves. Names the case."""
    for i, j in zip(stop, stop[1:]):
        seconds, _, knots = track.motion(i, j)
        if knots > limits.traj_speed_kn or seconds > limits.traj_gap_s:
            return "discard"
    first, last = track.at(stop[0]), track.at(stop[-1])
    ends = [k for k, m in enumerate(moves) if track.at(m[-1]) == first]
    starts = [k for k, m in enumerate(moves) if track.at(m[0]) == last]
    before, after = ends[-1] if ends else None, starts[-1] if starts else None
    if before is not None and after is not None and before != after:
        moves[before] = moves[before] + stop + moves[after]
        del moves[after]
        return "bridge"
    if before is not None:
        moves[before] = moves[before] + stop
        return "append"
    if after is not None:
        moves[after] = stop + moves[after]
        return "prepend"
    if len(stop) >= limits.traj_points:
        moves.append(stop)
        return "new"
    return "drop"


def segment(track: Track, limits: Thresholds = LIMITS) -> tuple[list[list[int]], list[list[int]]]:
    """Valid trajectories and stops."""
    moves, stays, _ = fold(track, limits)
    moves = [list(m) for m in moves]
    stops = []
    for stop in merge_stops(track, stays, limits):
        if is_stop(track, stop, limits):
            stops.append(stop)
        else:
            absorb(track, stop, moves, limits)
    span = lambda m: int(track.ts[m[-1]]) > int(track.ts[m[0]])
    return [m for m in moves if len(m) >= limits.traj_points and span(m)], stops


# ---- DataFrames ------------------------------------------------------------------------------------------------------


def _track(rows: pa.Table) -> Track:
    cols = [np.asarray(rows.column(c).to_numpy(), float) for c in ("lon", "lat", "sog", "epoch_ts")]
    order = np.lexsort((cols[0], cols[1], cols[3]))
    return Track(*[c[order] for c in cols])


def _vessel_days(points: DataFrame, by_day: bool) -> DataFrame:
    placed = points.dropna(subset=["mmsi", "lon", "lat", "epoch_ts"]).select("mmsi", "lon", "lat", F.col("sog").cast("double").alias("sog"), "epoch_ts", F.to_date("timestamp").alias("point_day"))
    return placed if by_day else placed.withColumn("point_day", F.lit(None).cast("date"))


def _grouped(points: DataFrame, by_day: bool, schema: str, work) -> DataFrame:
    return _vessel_days(points, by_day).groupBy("mmsi", "point_day").applyInArrow(lambda key, rows: work(key[0].as_py(), _track(rows)), schema)


def _lists(sizes: list[int], columns: list[np.ndarray], names: list[str], missing: np.ndarray) -> pa.Array:
    """A list of structs for each size, null where missing."""
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names), mask=pa.array(missing))


def objects(points: DataFrame, limits: Thresholds = LIMITS, by_day: bool = True, keep_errors: bool = False) -> DataFrame:
    """Trajectories (kind 'traj', with coords) and stops (kind 'stop', with ring) of all vessels, in seconds since 1970.

    A vessel-day that raises fails the job; with keep_errors it gives one row of kind 'error', with the first and last time of its
    points and what was raised in error, and the others go on."""

    shape = to_arrow_schema(StructType.fromDDL(OBJECTS))

    def work(mmsi, track):
        try:
            return build(mmsi, track)
        except Exception as e:
            if not keep_errors:
                raise
            row = {"mmsi": mmsi, "kind": "error", "seq": 0, "ts_start": int(track.t[0]), "ts_end": int(track.t[-1]), "coords": None, "ring": None, "error": f"{type(e).__name__}: {e}"}
            return pa.Table.from_pylist([row], schema=shape)

    def build(mmsi, track):
        moves, stops = segment(track, limits)
        made = [("traj", m) for m in moves] + [("stop", s) for s in stops]
        is_stop_row = np.array([k == "stop" for k, _ in made], bool)
        at = np.array([i for m in moves for i in m], np.int64)
        coords = _lists([0 if k == "stop" else len(m) for k, m in made], [track.lon[at], track.lat[at], track.ts[at]], ["lon", "lat", "ts"], is_stop_row)
        rings = [stop_ring(track, m, limits) for m in stops]
        corners = np.array([p for r in rings for p in r], float).reshape(-1, 2)
        ring = _lists([0] * len(moves) + [len(r) for r in rings], [corners[:, 0], corners[:, 1]], ["lon", "lat"], ~is_stop_row)
        return pa.table({
            "mmsi": pa.array([mmsi] * len(made), pa.int64()), "kind": pa.array([k for k, _ in made], pa.string()), "seq": pa.array(range(len(made)), pa.int32()),
            "ts_start": pa.array([int(track.t[m[0]]) for _, m in made], pa.int64()), "ts_end": pa.array([int(track.t[m[-1]]) for _, m in made], pa.int64()), "coords": coords, "ring": ring, "error": pa.nulls(len(made), pa.string()),
        })

    return _grouped(points, by_day, OBJECTS, work)


def point_labels(points: DataFrame, limits: Thresholds = LIMITS, by_day: bool = True) -> DataFrame:
    """What the fold takes each point for: init, dup, stop, move, gap or outlier."""

    def work(mmsi, track):
        return pa.table({"mmsi": pa.array([mmsi] * len(track.ts), pa.int64()), "epoch_ts": track.ts, "lat": track.lat, "lon": track.lon, "label": pa.array(fold(track, limits)[2], pa.string())})

    return _grouped(points, by_day, "mmsi long, epoch_ts double, lat double, lon double, label string", work)


def candidate_segments(points: DataFrame, limits: Thresholds = LIMITS, by_day: bool = True, merged: bool = False) -> DataFrame:
    """Candidate trajectories and stops, or with merged the stops after merging and whether each is valid."""

    def work(mmsi, track):
        moves, stays, _ = fold(track, limits)
        if merged:
            stays = merge_stops(track, stays, limits)
        made = [("stop", s) for s in stays] if merged else [("traj", m) for m in moves] + [("stop", s) for s in stays]
        return pa.table({
            "mmsi": pa.array([mmsi] * len(made), pa.int64()), "kind": pa.array([k for k, _ in made], pa.string()), "n_points": pa.array([len(m) for _, m in made], pa.int64()),
            "ts_start": pa.array([track.ts[m[0]] for _, m in made], pa.float64()), "ts_end": pa.array([track.ts[m[-1]] for _, m in made], pa.float64()),
            "is_valid": pa.array([is_stop(track, m, limits) if k == "stop" else None for k, m in made], pa.bool_()),
        })

    return _grouped(points, by_day, "mmsi long, kind string, n_points long, ts_start double, ts_end double, is_valid boolean", work)


def stop_validity(points: DataFrame, key: list[str], limits: Thresholds = LIMITS) -> DataFrame:
    """Whether points grouped by key make a valid stop, as plain aggregates: hull and box have the same bounds, so the
    hull itself is not needed. points has lon, lat and epoch_ts."""
    low, high = F.min("lon"), F.max("lon")
    out = points.groupBy(*key).agg(F.count("*").alias("n_points"), (F.floor(F.max("epoch_ts")) - F.floor(F.min("epoch_ts"))).cast("long").alias("duration"), low.alias("w"), F.min("lat").alias("s"), high.alias("e"), F.max("lat").alias("n"))
    area = mbr_area_m2(F.col("w"), F.col("s"), F.col("e"), F.col("n"))
    shape = ((F.col("w") == F.col("e")) & (F.col("s") == F.col("n"))) | ((F.col("w") < F.col("e")) & (F.col("s") < F.col("n")) & (area <= limits.stop_area_m2))
    return out.withColumn("is_valid", (F.col("n_points") >= limits.stop_points) & (F.col("duration") >= limits.stop_duration_s) & shape).select(*key, "n_points", "duration", "is_valid")
