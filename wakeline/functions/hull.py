"""Outlines of point sets: convex hull, and a concave hull by wearing down a Delaunay triangulation from its border."""

from __future__ import annotations

import heapq
import math

import numpy as np

Point = tuple[float, float]


def _turn(a: Point, b: Point, c: Point) -> float:
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def convex_hull(points) -> list[Point]:
    """Corners counter-clockwise, the first not repeated; one or two points if all are alike or in line."""
    p = sorted(set(points))
    if len(p) < 3:
        return p

    def half(seq):
        out: list[Point] = []
        for q in seq:
            while len(out) > 1 and _turn(out[-2], out[-1], q) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    hull = half(p) + half(reversed(p))
    return hull


def delaunay(points: list[Point]) -> list[tuple[int, int, int]]:
    """Triangles, counter-clockwise, of distinct points: each point is put in where a walk finds its triangle."""
    p = np.asarray(points, float)
    low, span = p.min(0), float(max(np.ptp(p, axis=0).max(), 1e-300))
    q = [tuple(x) for x in ((p - low) / span)]
    n = len(q)
    q += [(-50.0, -50.0), (51.0, -50.0), (0.5, 90.0)]
    triangles: dict[int, tuple[int, int, int]] = {0: (n, n + 1, n + 2)}
    across: dict[tuple[int, int], int] = {(n, n + 1): 0, (n + 1, n + 2): 0, (n + 2, n): 0}
    free, last = 1, 0

    def in_circle(t, d) -> bool:
        (ax, ay), (bx, by), (cx, cy) = (q[i] for i in t)
        ax, ay, bx, by, cx, cy = ax - d[0], ay - d[1], bx - d[0], by - d[1], cx - d[0], cy - d[1]
        a2, b2, c2 = ax * ax + ay * ay, bx * bx + by * by, cx * cx + cy * cy
        return ax * (by * c2 - b2 * cy) - ay * (bx * c2 - b2 * cx) + a2 * (bx * cy - by * cx) > 1e-18

    for i in sorted(range(n), key=lambda i: (int(q[i][0] * 32), q[i][1] if int(q[i][0] * 32) % 2 else -q[i][1])):
        d = q[i]
        at = last
        for _ in range(4 * len(triangles) + 8):
            a, b, c = triangles[at]
            for u, v in ((a, b), (b, c), (c, a)):
                if _turn(q[u], q[v], d) < 0 and (v, u) in across:
                    at = across[v, u]
                    break
            else:
                break
        bad, stack = {at}, [at]
        while stack:
            a, b, c = triangles[stack.pop()]
            for u, v in ((a, b), (b, c), (c, a)):
                t = across.get((v, u))
                if t is not None and t not in bad and in_circle(triangles[t], d):
                    bad.add(t)
                    stack.append(t)
        rim = []
        for t in bad:
            a, b, c = triangles[t]
            rim += [(u, v) for u, v in ((a, b), (b, c), (c, a)) if across.get((v, u)) not in bad]
        for t in bad:
            a, b, c = triangles.pop(t)
            for e in ((a, b), (b, c), (c, a)):
                across.pop(e, None)
        for u, v in rim:
            triangles[free] = (u, v, i)
            across[u, v] = across[v, i] = across[i, u] = free
            last, free = free, free + 1
    return [t for t in triangles.values() if max(t) < n]


def concave_hull(points, ratio: float = 0.2) -> list[Point]:
    """Corners of a polygon without holes around all points, counter-clockwise and the first not repeated.

    Border triangles of the Delaunay triangulation are taken away from the longest border edge on, while that edge is
    longer than least + ratio * (longest - least) over all edges, and while the rest stays one polygon with every point
    in it or on it. Points that are all alike or in line give what convex_hull gives."""
    distinct = sorted(set(points))
    corners = convex_hull(distinct)
    if len(corners) < 3 or len(distinct) < 4:
        return corners
    triangles = delaunay(distinct)
    length = lambda a, b: math.dist(distinct[a], distinct[b])
    owner: dict[tuple[int, int], int] = {}
    for k, (a, b, c) in enumerate(triangles):
        owner[a, b] = owner[b, c] = owner[c, a] = k
    sizes = [length(a, b) for a, b in owner if a < b or (b, a) not in owner]
    if not sizes:
        return corners
    limit = min(sizes) + ratio * (max(sizes) - min(sizes))
    border = {e for e in owner if (e[1], e[0]) not in owner}
    on_border = {a for a, _ in border}
    queue = [(-length(*e), e) for e in border]
    heapq.heapify(queue)
    while queue:
        size, (a, b) = heapq.heappop(queue)
        if -size <= limit:
            break
        if (a, b) not in border:
            continue
        c = next(x for x in triangles[owner[a, b]] if x not in (a, b))
        if c in on_border:
            continue  # the polygon would fall apart, or a point would be cut off
        del owner[a, b], owner[b, c], owner[c, a]
        border.discard((a, b))
        on_border.add(c)
        for e in ((a, c), (c, b)):
            border.add(e)
            heapq.heappush(queue, (-length(*e), e))
    follow = dict(border)
    if len(follow) != len(border):
        return corners
    start = min(follow)
    ring, at = [start], follow[start]
    while at != start and len(ring) <= len(follow):
        ring.append(at)
        at = follow[at]
    return [distinct[i] for i in ring] if len(ring) == len(follow) else corners


def around(lon: float, lat: float, radius: float, quarter: int = 16) -> list[Point]:
    """A polygon of 4 * quarter corners around a point."""
    step = math.pi / 2 / quarter
    return [(lon + radius * math.cos(i * step), lat + radius * math.sin(i * step)) for i in range(4 * quarter)]
