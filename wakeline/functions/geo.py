"""Distances, speeds and web-mercator grid arithmetic as column expressions (no Python at run time)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean earth radius in metres, metres a second in a knot.
EARTH_RADIUS_M = 6_371_000.0
KNOT_MPS = 0.514444


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres between two points in degrees."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp, dl = F.sin((p2 - p1) / 2), F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    return F.lit(EARTH_RADIUS_M) * 2 * F.asin(F.sqrt(dp * dp + F.cos(p1) * F.cos(p2) * dl * dl))


def speed_kn(distance_m: Column, seconds: Column) -> Column:
    """Knots; infinite if no time has passed."""
    return F.when(seconds > 0, F.try_divide(distance_m, seconds) / KNOT_MPS).otherwise(F.lit(float("inf")))


def mbr_area_m2(min_lon: Column, min_lat: Column, max_lon: Column, max_lat: Column) -> Column:
    """Width along the lower edge times height of a bounding box, in square metres."""
    return haversine_m(min_lon, min_lat, max_lon, min_lat) * haversine_m(min_lon, min_lat, min_lon, max_lat)


def tile_fraction_x(lon: Column, zoom: int) -> Column:
    return F.pmod(F.lit(float(1 << zoom)) * (lon / 360.0 + 0.5), F.lit(float(1 << zoom)))


def tile_fraction_y(lat: Column, zoom: int) -> Column:
    """Null at the poles, where the projection has no value."""
    s = F.sin(lat * math.pi / 180.0)
    y = F.lit(float(1 << zoom)) * (F.lit(0.5) - F.lit(0.25) * F.ln(F.try_divide(1 + s, 1 - s)) / math.pi)
    return F.when(y.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(float((1 << zoom) - 1)), y)))


def tile_x(lon: Column, zoom: int) -> Column:
    return F.floor(tile_fraction_x(lon, zoom)).cast("long")


def tile_y(lat: Column, zoom: int) -> Column:
    return F.floor(tile_fraction_y(lat, zoom)).cast("long")


def _spread(v: Column) -> Column:
    """Bits of a number moved apart, one free bit after each: its binary digits read as digits of base 4. The argument
    occurs once, so that expressions made of this stay small enough for code generation."""
    return F.conv(F.bin(v), 4, 10).cast("long")


def _gather(v: Column) -> Column:
    return F.conv(F.conv(v.bitwiseAND(F.lit(0x5555555555555555)).cast("string"), 10, 4), 2, 10).cast("long")


def cell_id(x: Column, y: Column) -> Column:
    """The cell of a tile: bits of x at even and of y at odd places (the base-4 value of the quadkey)."""
    return _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1))


def cell_x(cell: Column) -> Column:
    return _gather(cell)


def cell_y(cell: Column) -> Column:
    return _gather(F.shiftright(cell, 1))


def lonlat_cell(lon: Column, lat: Column, zoom: int) -> Column:
    return cell_id(tile_x(lon, zoom), tile_y(lat, zoom))


def parent_cell(cell: Column, zoom: int, to_zoom: int) -> Column:
    return F.shiftright(cell, 2 * (zoom - to_zoom))


def child_cells(cell: Column, zoom: int, to_zoom: int) -> Column:
    """All descendants at a zoom, as an array; the cell alone if the zoom is not deeper."""
    if to_zoom <= zoom:
        return F.array(cell)
    step = 2 * (to_zoom - zoom)
    first = F.shiftleft(cell, step)
    return F.sequence(first, first + F.lit((1 << step) - 1))


def tile_west(x: Column, zoom: int) -> Column:
    return x / float(1 << zoom) * 360.0 - 180.0


def tile_north(y: Column, zoom: int) -> Column:
    return F.degrees(F.atan(F.sinh(F.lit(math.pi) * (1 - F.lit(2.0) * y / float(1 << zoom)))))


def tile_bounds(x: Column, y: Column, zoom: int) -> Column:
    """west, south, east and north of a tile in degrees."""
    return F.struct(tile_west(x, zoom).alias("west"), tile_north(y + 1, zoom).alias("south"), tile_west(x + 1, zoom).alias("east"), tile_north(y, zoom).alias("north"))


# ---- the older decimal cell ids -------------------------------------------------------------------------------


def decimal_layout(zoom: int) -> tuple[int, int]:
    """Offset and factor of x. Any other zoom takes those of zoom 21."""
    return {13: (100_000_000, 10_000), 17: (1_000_000_000_000, 1_000_000)}.get(zoom, (100_000_000_000_000, 10_000_000))


def decimal_cell(x: Column, y: Column, zoom: int) -> Column:
    offset, factor = decimal_layout(zoom)
    return F.lit(offset).cast("long") + x * F.lit(factor).cast("long") + y


def decimal_cell_x(cell: Column, zoom: int) -> Column:
    offset, factor = decimal_layout(zoom)
    return F.floor((cell - F.lit(offset).cast("long")) / F.lit(factor).cast("long")).cast("long")


def decimal_cell_y(cell: Column, zoom: int) -> Column:
    offset, factor = decimal_layout(zoom)
    return (cell - F.lit(offset).cast("long")) % F.lit(factor).cast("long")


def mercator_tile_x(lon: Column, zoom: int) -> Column:
    """Tile of a longitude without wrapping, held within the grid."""
    return F.greatest(F.lit(0), F.least(F.lit((1 << zoom) - 1), F.floor((lon / 360.0 + 0.5) * float(1 << zoom)).cast("long")))


def decimal_lonlat_cell(lon: Column, lat: Column, zoom: int = 21) -> Column:
    return decimal_cell(mercator_tile_x(lon, zoom), tile_y(lat, zoom), zoom)
