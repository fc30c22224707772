"""Schemas of the transformed zone and of every message.

Column names and types are fixed values of the data contract. The transformed zone, events and
payloads are read with these schemas; raw grids and marts take theirs from the Parquet footer.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _doubles(*names: str) -> list[StructField]:
    return [StructField(n, DoubleType()) for n in names]


# Raw grid zone: one row per (time, latitude, longitude). ``time`` is stored either as a
# timestamp or as epoch nanoseconds (bigint), see ``functions.normalize_time``.
RAW_VARIABLES = ("t2m", "cape", "blh", "u10", "v10", "d2m", "sp", "tcc")
RAW_AUXILIARY = ("number", "step", "surface", "expver", "valid_time")

# Transformed zone, partitioned by year and month; ``cell_id`` is this library's own (``functions.cells``).
OBS_SCHEMA = StructType(
    [
        StructField("time", TimestampType()),
        *_doubles("latitude", "longitude", "cape", "blh", "sp", "tcc"),
        StructField("day", IntegerType()),
        StructField("hour", IntegerType()),
        *_doubles("temp_c", "dewpoint_c", "wind_speed", "wind_dir", "cloud_base_m"),
        StructField("fog_condition", BooleanType()),
        *[StructField(n, StringType()) for n in ("flying_category", "thermal_strength", "time_of_day", "season")],
        StructField("cell_id", LongType()),
        StructField("year", IntegerType()),
        StructField("month", IntegerType()),
    ]
)

# One live station event (JSON message value).
EVENT_SCHEMA = StructType(
    [
        StructField("timestamp", StringType()),
        StructField("location", StringType()),
        *_doubles(
            "lat", "lon", "temp_c", "dewpoint_c", "pressure", "humidity", "wind_speed", "wind_dir", "wind_gust",
            "cloud_cover", "visibility",
        ),
        StructField("weather_desc", StringType()),
        StructField("cloud_base_m", DoubleType()),
    ]
)

# Station weather payload as returned by the weather service.
STATION_PAYLOAD_SCHEMA = StructType(
    [
        StructField("coord", StructType(_doubles("lat", "lon"))),
        StructField("main", StructType(_doubles("temp", "pressure", "humidity"))),
        StructField("wind", StructType(_doubles("speed", "deg", "gust"))),
        StructField("clouds", StructType(_doubles("all"))),
        StructField("visibility", DoubleType()),
        StructField("weather", ArrayType(StructType([StructField("description", StringType())]))),
    ]
)
