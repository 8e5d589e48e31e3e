"""Built-in passages and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wakeline.schemas import PASSAGE_LS

from .geojson import regions

# Names and end points of the passages.
PASSAGES = [
    ("Skagen", (10.6547341, 57.7469023), (11.6832043, 57.8390526)),
    ("Kiel", (10.6398103, 54.707243), (10.7675855, 54.518765)),
    ("Storebælt Nord", (10.6218303, 55.7653698), (10.8689216, 55.7433214)),
    ("Storebælt Syd", (10.7168396, 54.727667), (10.9955755, 54.7712645)),
    ("Sundet Nord", (12.2843156, 56.1277941), (12.4463371, 56.3009201)),
    ("Sundet Syd", (12.4472826, 55.2994701), (12.812782, 55.3828301)),
    ("Bornholms Gate", (14.2737822, 55.4560996), (14.7232539, 55.2377075)),
    ("Kadetrenden", (11.9681072, 54.5605233), (12.4027844, 54.3751052)),
    ("Fynshoved", (10.5992236, 55.6179156), (10.6111518, 55.7628973)),
    ("Lillebælt Nord", (10.0298125, 55.6977269), (10.1637184, 55.6449764)),
    ("Lillebælt Syd", (10.4195311, 54.8146529), (9.9537696, 54.7766516)),
    ("Bornholm Syd", (14.8267825, 55.0423356), (14.8352947, 54.4869928)),
]

# Names, western, southern, eastern and northern edge of the regions.
REGIONS = [
    ("small_region_high_traffic", 11.302686710292562, 57.540218011472916, 11.320601618292642, 57.549104802914286),
    ("medium_region_high_traffic", 11.276438684098508, 57.51939355360108, 11.347866356214155, 57.56958925461157),
    ("medium-large_region_high_traffic", 11.217732760313481, 57.49110293791702, 11.405738229992068, 57.59328938571025),
    ("large_region_high_traffic", 11.146654152435246, 57.44467119498023, 11.484234973055834, 57.63829370559395),
    ("small_region_low_traffic", 10.902686710292562, 57.090218011472916, 10.920601618292642, 57.099104802914286),
    ("medium_region_low_traffic", 10.876438684098508, 57.06939355360108, 10.947866356214155, 57.11958925461157),
    ("medium-large_region_low_traffic", 10.81773276031348, 57.041102937917024, 11.005738229992067, 57.14328938571025),
    ("large_region_low_traffic", 10.746654152435246, 56.99467119498023, 11.084234973055834, 57.18829370559395),
]


def passages(spark: SparkSession, lines: list = PASSAGES) -> DataFrame:
    rows = [(i, name, [{"lon": a, "lat": b} for a, b in ends]) for i, (name, *ends) in enumerate(lines, 1)]
    return spark.createDataFrame(rows, PASSAGE_LS)


def rectangle(west: float, south: float, east: float, north: float) -> list:
    """A polygon of one closed ring, from the north-western corner on."""
    return [[(west, north), (west, south), (east, south), (east, north), (west, north)]]


def region_polygons(spark: SparkSession) -> DataFrame:
    return regions(spark, [(i, name, [rectangle(*box)]) for i, (name, *box) in enumerate(REGIONS, 1)])
