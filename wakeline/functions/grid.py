"""Cells of lines and polygons: numpy kernels and the Arrow functions and DataFrame pipelines around them."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

FULL, PARTIAL, NONE = 2, 1, 0


def morton(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cell ids of tiles."""

    def spread(v):
        v = np.asarray(v, np.int64)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = (v | (v << shift)) & mask
        return v

    return spread(x) | (spread(y) << 1)


def unmorton(cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    def gather(v):
        v = np.asarray(v, np.int64) & 0x5555555555555555
        for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0xFFFFFFFF)):
            v = (v | (v >> shift)) & mask
        return v

    return gather(cell), gather(np.asarray(cell, np.int64) >> 1)


def fractions(lon: np.ndarray, lat: np.ndarray, zoom: int) -> tuple[np.ndarray, np.ndarray]:
    """Fractional tile coordinates; x wraps, y is held within the grid and is nan at the poles."""
    n = float(1 << zoom)
    x = np.mod(n * (np.asarray(lon, float) / 360.0 + 0.5), n)
    with np.errstate(divide="ignore", invalid="ignore"):
        s = np.array([math.sin(v * math.pi / 180.0) for v in np.ravel(lat)])
        ratio = (1 + s) / (1 - s)
        logs = np.array([math.log(r) if 0 < r < math.inf else math.nan for r in ratio])
    y = n * (0.5 - 0.25 * logs / math.pi)
    return x, np.clip(y, 0.0, n - 1)


def _crossings(at: float, cell: int, move: float) -> np.ndarray:
    """Times in [0, 1) at which a coordinate that moves so much from `at` meets the next grid lines, summed step by step."""
    if move == 0:
        return np.zeros(0)
    first, step = abs(((1 if move > 0 else 0) + cell - at) / move), abs(1 / move)
    if first >= 1:
        return np.zeros(0)
    times = np.full(int((1 - first) / step) + 3, step)
    times[0] = first
    times = np.cumsum(times)
    return times[times < 1]


def line_cells(lon, lat, ts=None, zoom: int = 21) -> tuple[np.ndarray, np.ndarray]:
    """Cells that a line passes, in its order, with the time of entry; a cell that follows itself is one entry.

    Each pair of vertices is walked from grid line to grid line, at a tie first to the next row. The cells of a pair get
    times evenly from the first vertex's whole second to the last one's, rounded half to even. Vertices without times
    give times of 0. A pair of equal vertices counts only while nothing has been found yet. A line with a vertex at a
    pole has no cells."""
    x, y = fractions(lon, lat, zoom)
    none = np.zeros(0, np.int64)
    if len(x) < 2 or np.isnan(y).any() or np.isnan(x).any():
        return none, none
    when = np.trunc(np.asarray(ts, float)).astype(np.int64) if ts is not None else np.zeros(len(x), np.int64)
    cx, cy = np.floor(x).astype(np.int64), np.floor(y).astype(np.int64)
    xs, ys, times, any_yet = [], [], [], False
    for i in range(len(x) - 1):
        dx, dy = x[i + 1] - x[i], y[i + 1] - y[i]
        if dx == 0 and dy == 0 and any_yet:
            continue
        any_yet = True
        tx, ty = _crossings(x[i], int(cx[i]), dx), _crossings(y[i], int(cy[i]), dy)
        n = len(tx) + len(ty)
        if not n:
            xs.append(cx[i : i + 1])
            ys.append(cy[i : i + 1])
            times.append(when[i : i + 1])
            continue
        column = np.concatenate([np.zeros(len(ty), np.int64), np.ones(len(tx), np.int64)])
        column = column[np.argsort(np.concatenate([ty, tx]), kind="stable")]
        move_x, move_y = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        np.cumsum(column, out=move_x[1:])
        np.cumsum(1 - column, out=move_y[1:])
        xs.append(cx[i] + (move_x if dx > 0 else -move_x))
        ys.append(cy[i] + (move_y if dy > 0 else -move_y))
        times.append(np.rint(when[i] + np.arange(n + 1) / n * (when[i + 1] - when[i])).astype(np.int64))
    cells, entry = morton(np.concatenate(xs), np.concatenate(ys)), np.concatenate(times)
    new = np.ones(len(cells), bool)
    new[1:] = cells[1:] != cells[:-1]
    return cells[new], entry[new]


def exit_times(entry: np.ndarray, end: int) -> np.ndarray:
    """A cell is left when the next one is entered, the last at the line's end; never before it is entered."""
    return np.maximum(entry, np.append(entry[1:], end)) if len(entry) else entry


# ---- polygons -----------------------------------------------------------------------------------------------------


class Shape:
    """Rings of one or more polygons, for classifying boxes. Inside is what an odd number of rings encloses."""

    def __init__(self, polygons):
        edges = []
        for rings in polygons:
            for ring in rings:
                p = np.asarray(ring, float).reshape(-1, 2)
                if len(p) >= 3:
                    if (p[0] != p[-1]).any():
                        p = np.vstack([p, p[:1]])
                    edges.append(np.hstack([p[:-1], p[1:]]))
        self.edges = np.concatenate(edges) if edges else np.zeros((0, 4))

    @property
    def empty(self) -> bool:
        return not len(self.edges)

    def bounds(self):
        e = self.edges
        return e[:, [0, 2]].min(), e[:, [1, 3]].min(), e[:, [0, 2]].max(), e[:, [1, 3]].max()

    def classify(self, west, south, east, north) -> np.ndarray:
        """FULL, PARTIAL or NONE for closed boxes; an edge along a box's side makes it PARTIAL."""
        out = np.zeros(len(west), np.int8)
        for a in range(0, len(west), 4096):
            out[a : a + 4096] = self._classify(west[a : a + 4096], south[a : a + 4096], east[a : a + 4096], north[a : a + 4096])
        return out

    def _classify(self, w, s, e, n):
        met, inside = np.zeros(len(w), bool), np.zeros(len(w), bool)
        mx, my = (w + e) / 2, (s + n) / 2
        for x0, y0, x1, y1 in self.edges:
            near = (max(x0, x1) >= w) & (min(x0, x1) <= e) & (max(y0, y1) >= s) & (min(y0, y1) <= n) & ~met
            if near.any():
                met[near] |= _meets(x0, y0, x1, y1, w[near], s[near], e[near], n[near])
            if y0 != y1:
                crosses = (y0 > my) != (y1 > my)
                if crosses.any():
                    inside ^= crosses & (mx < (x1 - x0) * (my - y0) / (y1 - y0) + x0)
        return np.where(met, PARTIAL, np.where(inside, FULL, NONE)).astype(np.int8)


def _meets(x0, y0, x1, y1, w, s, e, n):
    """Whether a segment meets closed boxes, by clipping its parameter range against each side."""
    lo, hi = np.zeros(len(w)), np.ones(len(w))
    ok = np.ones(len(w), bool)
    for start, move, low, high in ((x0, x1 - x0, w, e), (y0, y1 - y0, s, n)):
        if move == 0:
            ok &= (start >= low) & (start <= high)
        else:
            a, b = (low - start) / move, (high - start) / move
            lo, hi = np.maximum(lo, np.minimum(a, b)), np.minimum(hi, np.maximum(a, b))
    return ok & (lo <= hi)


def tile_box(x, y, zoom: int):
    """west, south, east, north of tiles, in degrees."""
    n = float(1 << zoom)
    lat = lambda v: np.degrees(np.arctan(np.sinh(np.pi * (1 - 2 * np.asarray(v, float) / n))))
    x = np.asarray(x, float)
    return x / n * 360 - 180, lat(np.asarray(y) + 1), (x + 1) / n * 360 - 180, lat(y)


def box_tiles(shape: Shape, zoom: int) -> tuple[np.ndarray, np.ndarray]:
    """Tiles that the shape's bounding box covers, columns first."""
    w, s, e, n = shape.bounds()
    top = (1 << zoom) - 1
    xs, ys = fractions(np.array([w, e]), np.array([n, s]), zoom)
    raw = np.floor((np.array([w, e]) / 360.0 + 0.5) * (1 << zoom)).clip(0, top).astype(np.int64)
    ys = np.floor(np.nan_to_num(ys, nan=0.0)).astype(np.int64)
    if s <= -90:
        ys[1] = top
    x, y = np.meshgrid(np.arange(raw[0], raw[1] + 1), np.arange(ys[0], ys[1] + 1), indexing="ij")
    return x.ravel(), y.ravel()


def flat_cover(polygons, zoom: int) -> np.ndarray:
    """All cells of a zoom that a shape meets, columns first and each from north to south."""
    shape = Shape(polygons)
    if shape.empty:
        return np.zeros(0, np.int64)
    x, y = box_tiles(shape, zoom)
    hit = shape.classify(*tile_box(x, y, zoom)) > NONE
    return morton(x[hit], y[hit])


def children(cells: np.ndarray, steps: int) -> np.ndarray:
    return ((np.asarray(cells, np.int64)[:, None] << (2 * steps)) + np.arange(1 << (2 * steps))).ravel()


def split_cells(shape: Shape, zoom: int, full: np.ndarray, partial: np.ndarray, to_zoom: int) -> tuple[np.ndarray, np.ndarray]:
    """Full and partial cells one level down: children of full cells are full unseen."""
    deeper = children(partial, to_zoom - zoom)
    kind = shape.classify(*tile_box(*unmorton(deeper), to_zoom)) if len(deeper) else np.zeros(0, np.int8)
    return np.concatenate([children(full, to_zoom - zoom), deeper[kind == FULL]]), deeper[kind == PARTIAL]


def polygon_cells(polygons, skip_z21: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of zoom 13, 17 and 21 that a shape meets; each zoom looks only at what the one before left open."""
    shape = Shape(polygons)
    none = np.zeros(0, np.int64)
    if shape.empty:
        return none, none, none
    x, y = box_tiles(shape, 13)
    kind = shape.classify(*tile_box(x, y, 13))
    cells = morton(x, y)
    full, partial = cells[kind == FULL], cells[kind == PARTIAL]
    out = [np.concatenate([full, partial])]
    for zoom, deeper in ((13, 17), (17, 21)):
        if deeper == 21 and skip_z21:
            out.append(none)
            break
        full, partial = split_cells(shape, zoom, full, partial, deeper)
        out.append(np.concatenate([full, partial]))
    return out[0], out[1], out[2]


def lists(items: list[np.ndarray], kind=pa.int64()) -> pa.Array:
    """A list array of the items."""
    ends = np.concatenate([[0], np.cumsum([len(x) for x in items])]).astype(np.int32) if items else np.zeros(1, np.int32)
    flat = np.concatenate([*items, np.zeros(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))
