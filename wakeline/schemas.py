"""Explicit schemas of all tables. Timestamps are without zone, in UTC; cell ids of zoom 21 take 42 bits of a long."""

from __future__ import annotations

from pyspark.sql import types as T

_ID = lambda name: T.StructField(name, T.IntegerType(), False)
_LONG = lambda name, null=False: T.StructField(name, T.LongType(), null)
_TIME = lambda name, null=False: T.StructField(name, T.TimestampNTZType(), null)
_DOUBLE = lambda name, null=False: T.StructField(name, T.DoubleType(), null)
_TEXT = lambda name, null=False: T.StructField(name, T.StringType(), null)

COORD = T.StructType([_DOUBLE("lon", True), _DOUBLE("lat", True), _DOUBLE("ts", True)])
LONLAT = T.StructType([_DOUBLE("lon", True), _DOUBLE("lat", True)])
COORDS, RING = T.ArrayType(COORD), T.ArrayType(LONLAT)
POLYGONS = T.ArrayType(T.ArrayType(RING))  # polygons of rings; further rings of a polygon are holes
CELLS = T.ArrayType(T.LongType())
_ARRAYS = [T.StructField(f"cellstring_z{z}", CELLS, False) for z in (13, 17, 21)]

RAW_AIS = T.StructType([_LONG("mmsi", True), _DOUBLE("lat", True), _DOUBLE("lon", True), _DOUBLE("sog", True), _TIME("timestamp", True), _TEXT("transponder_type", True)])
POINTS = T.StructType([_LONG("mmsi"), _DOUBLE("lat"), _DOUBLE("lon"), _DOUBLE("sog", True), _TIME("timestamp"), _DOUBLE("epoch_ts")])
POINTS_INGESTION_LOG = T.StructType([_TEXT("file_name"), _TEXT("file_path"), T.StructField("file_date", T.DateType(), False), _TIME("min_ts", True), _TIME("max_ts", True), _TIME("loaded_at")])
TRAJECTORY_LS = T.StructType([_ID("trajectory_id"), _LONG("mmsi"), _TIME("ts_start"), _TIME("ts_end"), T.StructField("coords", COORDS, False)])
STOP_POLY = T.StructType([_ID("stop_id"), _LONG("mmsi"), _TIME("ts_start"), _TIME("ts_end"), T.StructField("ring", RING, False)])
CONSTRUCT_ERRORS = T.StructType([_LONG("mmsi"), _TIME("ts_start"), _TIME("ts_end"), _TEXT("error")])
TRAJECTORY_CS = T.StructType([_ID("trajectory_id"), _LONG("mmsi"), _TIME("ts_entry"), _TIME("ts_exit"), _LONG("cell_z21")])
STOP_CS = T.StructType([_ID("stop_id"), _LONG("mmsi"), _TIME("ts_start"), _TIME("ts_end"), _LONG("cell_z21")])
REGION_POLY = T.StructType([_ID("region_id"), _TEXT("name"), T.StructField("geom", POLYGONS, False)])
REGION_CS = T.StructType([_ID("region_id"), _TEXT("name"), _LONG("cell_z21")])
REGION_CS_COARSE = {z: T.StructType([_ID("region_id"), _TEXT("name"), _LONG(f"cell_z{z}")]) for z in (13, 17)}
PASSAGE_LS = T.StructType([_ID("passage_id"), _TEXT("name"), T.StructField("coords", RING, False)])
PASSAGE_CS = T.StructType([_ID("passage_id"), _TEXT("name"), _LONG("cell_z21")])
PASSAGE_CS_COARSE = {z: T.StructType([_ID("passage_id"), _TEXT("name"), _LONG(f"cell_z{z}")]) for z in (13, 17)}
TRAJECTORY_CS_ARRAYS = T.StructType([_ID("trajectory_id"), _LONG("mmsi"), _TIME("ts_start"), _TIME("ts_end"), *_ARRAYS])
STOP_CS_ARRAYS = T.StructType([_ID("stop_id"), _LONG("mmsi"), _TIME("ts_start"), _TIME("ts_end"), *_ARRAYS])
REGION_CS_ARRAYS = T.StructType([_ID("region_id"), _TEXT("name"), *_ARRAYS])
PASSAGE_CS_ARRAYS = T.StructType([_ID("passage_id"), _TEXT("name"), *_ARRAYS])

#: Tables of the two logical namespaces: lines and polygons, and cells.
LS_TABLES = {"points": POINTS, "points_ingestion_log": POINTS_INGESTION_LOG, "trajectory_ls": TRAJECTORY_LS, "stop_poly": STOP_POLY, "construct_errors": CONSTRUCT_ERRORS, "region_poly": REGION_POLY, "passage_ls": PASSAGE_LS}
CS_TABLES = {"trajectory_cs": TRAJECTORY_CS, "stop_cs": STOP_CS, "region_cs": REGION_CS, "passage_cs": PASSAGE_CS}
CS_TABLES |= {f"region_cs_z{z}": s for z, s in REGION_CS_COARSE.items()} | {f"passage_cs_z{z}": s for z, s in PASSAGE_CS_COARSE.items()}
