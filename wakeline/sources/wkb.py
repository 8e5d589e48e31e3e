"""Well-known binary of lines with measures and of polygons, for exchange with other tools."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: ISO type codes.
LINESTRING, POLYGON, LINESTRING_M = 2, 3, 2002


def line_m(lon, lat, ts) -> bytes:
    """LineString M; the measure is the whole second."""
    body = np.column_stack([lon, lat, np.trunc(np.asarray(ts, float))]).astype("<f8")
    return struct.pack("<BII", 1, LINESTRING_M, len(body)) + body.tobytes()


def polygon(rings) -> bytes:
    parts = [struct.pack("<BII", 1, POLYGON, len(rings))]
    for ring in rings:
        body = np.asarray(ring, "<f8").reshape(-1, 2)
        parts += [struct.pack("<I", len(body)), body.tobytes()]
    return b"".join(parts)


def decode(data: bytes):
    """('line', rows of ordinates) or ('polygon', rings); little or big endian, with or without measures (ISO or extended codes)."""
    order = "<" if data[0] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", data, 1)
    at = 5 + (4 if code & 0x20000000 else 0)
    has_m, has_z = bool(code & 0x40000000) or code // 1000 % 10 in (2, 3), bool(code & 0x80000000) or code // 1000 % 10 in (1, 3)
    width, kind = 2 + has_m + has_z, (code & 0xFFFF) % 1000

    def rows(at: int):
        (n,) = struct.unpack_from(order + "I", data, at)
        return np.frombuffer(data, order + "f8", n * width, at + 4).reshape(n, width), at + 4 + 8 * n * width

    if kind == LINESTRING:
        return "line", rows(at)[0]
    if kind == POLYGON:
        (n,) = struct.unpack_from(order + "I", data, at)
        at, rings = at + 4, []
        for _ in range(n):
            ring, at = rows(at)
            rings.append(ring)
        return "polygon", rings
    raise ValueError(f"geometry type {kind} is not supported")


def with_wkb(df: DataFrame, coords: str, name: str = "geom_wkb") -> DataFrame:
    """df with the binary of a column of vertices: lines with (lon, lat, ts), polygons of one ring with (lon, lat)."""
    from wakeline.operators.cover import _coords, _map

    def work(column):
        made = [line_m(*c) if len(c) > 2 else polygon([np.column_stack(c)]) for c in _coords(column)]
        return [pa.array(made, pa.binary())]

    return _map(df, coords, f"`{name}` binary", work)
