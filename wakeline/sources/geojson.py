"""Regions from GeoJSON."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from wakeline.schemas import REGION_POLY


def parse_region(text: str) -> list:
    """Polygons, each a list of rings of (lon, lat), of a Feature or the first feature of a FeatureCollection.

    Raises ValueError for anything else, a bare geometry too, and for geometries other than Polygon and MultiPolygon."""
    value = json.loads(text)
    kind = value.get("type") if isinstance(value, dict) else None
    if kind == "FeatureCollection":
        features = value.get("features") or []
        if not features:
            raise ValueError("the FeatureCollection has no feature")
        value = features[0]
    elif kind != "Feature":
        raise ValueError(f"expected a Feature or a FeatureCollection, not {kind}")
    shape = value.get("geometry") or {}
    if shape.get("type") == "Polygon":
        polygons = [shape["coordinates"]]
    elif shape.get("type") == "MultiPolygon":
        polygons = shape["coordinates"]
    else:
        raise ValueError(f"expected a Polygon or a MultiPolygon, not {shape.get('type')}")
    return [[[(float(p[0]), float(p[1])) for p in ring] for ring in rings] for rings in polygons]


def read_region(spark: SparkSession, path: str) -> list:
    """parse_region of a file in any file system that Spark reads."""
    return parse_region("\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect()))


def regions(spark: SparkSession, named: list[tuple[int, str, list]]) -> DataFrame:
    """A region table of (id, name, polygons)."""
    rows = [(i, name, [[[{"lon": float(a), "lat": float(b)} for a, b in ring] for ring in rings] for rings in polygons]) for i, name, polygons in named]
    return spark.createDataFrame(rows, REGION_POLY)
