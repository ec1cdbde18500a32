"""Declared schemas and the rules behind computed column names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

TRAIN, TEST = "train", "test"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_TRIP_HEAD = (("id", T.StringType()), ("vendor_id", T.LongType()), ("pickup_datetime", T.TimestampNTZType()))
_TRIP_BODY = (
    ("passenger_count", T.LongType()),
    ("pickup_longitude", T.DoubleType()),
    ("pickup_latitude", T.DoubleType()),
    ("dropoff_longitude", T.DoubleType()),
    ("dropoff_latitude", T.DoubleType()),
    ("store_and_fwd_flag", T.StringType()),
)
TRAIN_TRIPS = _struct(
    *_TRIP_HEAD, ("dropoff_datetime", T.TimestampNTZType()), *_TRIP_BODY, ("trip_duration", T.LongType())
)
TEST_TRIPS = _struct(*_TRIP_HEAD, *_TRIP_BODY)

ROUTES = _struct(
    ("id", T.StringType()),
    ("starting_street", T.StringType()),
    ("end_street", T.StringType()),
    ("total_distance", T.DoubleType()),
    ("total_travel_time", T.DoubleType()),
    ("number_of_steps", T.LongType()),
    ("street_for_each_step", T.StringType()),
    ("distance_per_step", T.StringType()),
    ("travel_time_per_step", T.StringType()),
    ("step_maneuvers", T.StringType()),
    ("step_direction", T.StringType()),
    ("step_location_list", T.StringType()),
)
# Route columns that only describe single steps; dropped once the features are built.
ROUTE_STEP_COLUMNS = (
    "starting_street",
    "end_street",
    "street_for_each_step",
    "distance_per_step",
    "travel_time_per_step",
    "step_maneuvers",
    "step_direction",
    "step_location_list",
)

# The weather file holds these by position after its date column. All are read as text, because
# amounts too small to measure are written as a letter.
WEATHER_COLUMNS = (
    "maximum_temerature",
    "minimum_temperature",
    "average_temperature",
    "precipitation",
    "snow_fall",
    "snow_depth",
)
WEATHER = _struct(("date", T.StringType()), *((name, T.StringType()) for name in WEATHER_COLUMNS))

# Fixed value.
INJURED = "NUMBER OF PERSONS INJURED"

MODEL_DROPPED = ("pickup_datetime", "dropoff_datetime")


def pickup_cluster(k: int) -> str:
    return f"pickup_kmeans_{k}_cluster"


def dropoff_cluster(k: int) -> str:
    return f"dropoff_kmeans_{k}_cluster"


def mean_name(target: str, key: str, suffix: str = "") -> str:
    return f"{target}_gby_{key}{suffix}"


def multi_name(measure: str, keys: Sequence[str], suffix: str = "") -> str:
    return f"{measure}_{'_'.join(keys)}{suffix}"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers arrive as NaN from some writers; SQL semantics need them as NULL."""
    doubles = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *(F.nanvl(F.col(f"`{c}`"), F.lit(None)).alias(c) if c in doubles else F.col(f"`{c}`") for c in df.columns)
    )
