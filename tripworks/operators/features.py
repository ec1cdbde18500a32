"""Operators that add feature columns to trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tripworks.functions import calendar, geo


def with_calendar(df: DataFrame, weekend_days: tuple[int, ...] = (0, 6), time_delta: Column | None = None) -> DataFrame:
    """Calendar parts of the pickup, its offset from the first pickup of all rows and cyclic forms.

    The first pickup comes from a scalar subquery, so no window without partitions is involved. ``time_delta``
    may give the offset where it is known.
    """
    pickup = F.col("pickup_datetime")
    parts = df.withColumns(
        {
            "pickup_month": F.month(pickup),
            "pickup_day": F.dayofmonth(pickup),
            "pickup_hour": F.hour(pickup),
            "pickup_weekofyear": F.weekofyear(pickup),
            "pickup_weekday": F.weekday(pickup),
        }
    )
    weekday, hour = F.col("pickup_weekday"), F.col("pickup_hour")
    if time_delta is None:
        time_delta = calendar.seconds_between(df.agg(F.min("pickup_datetime")).scalar(), pickup)
    position = calendar.week_position(weekday, hour, F.minute(pickup))
    return parts.withColumns(
        {
            "pickup_week_hour": calendar.week_hour(weekday, hour),
            "is_weekend": calendar.is_weekend(weekday, weekend_days),
            "pickup_time_delta": time_delta,
            "pickup_week_delta": position,
            "pickup_week_delta_sin": calendar.half_wave(position, 7),
            "pickup_hour_sin": calendar.half_wave(hour, 24),
        }
    )


def with_pca(df: DataFrame) -> DataFrame:
    """Rotate pickup and dropoff coordinates onto the principal axes of all points together.

    Two dimensions have a closed form: the major axis lies at half the angle of
    (2 cov, var_lat - var_lng). The moments of the stacked points follow from the moments of
    pickups and dropoffs, so one aggregate over the trips is enough and no row is doubled.
    Larger variance comes first; on each axis the latitude loading is not negative.
    """
    cos, sin, side = (F.col(f"_axes.{name}") for name in ("cos", "sin", "side"))
    added = {}
    for end in ("pickup", "dropoff"):
        lat = F.col(f"{end}_latitude") - F.col("_axes.lat")
        lng = F.col(f"{end}_longitude") - F.col("_axes.lng")
        added[f"{end}_pca0"] = lat * cos + lng * sin
        added[f"{end}_pca1"] = (lat * sin - lng * cos) * side
    return df.withColumn("_axes", _stacked_axes(df).scalar()).withColumns(added).drop("_axes")


def _stacked_axes(df: DataFrame) -> DataFrame:
    """One row: the centre of all points, the direction of the major axis and the sign of the minor."""
    aggregates = []
    for end in ("pickup", "dropoff"):
        lat, lng = F.col(f"{end}_latitude"), F.col(f"{end}_longitude")
        whole = lat.isNotNull() & lng.isNotNull()
        lat, lng = F.when(whole, lat), F.when(whole, lng)
        aggregates += [
            F.count(lat).cast("double").alias(f"{end}_n"),
            F.avg(lat).alias(f"{end}_lat"),
            F.avg(lng).alias(f"{end}_lng"),
            F.var_pop(lat).alias(f"{end}_var_lat"),
            F.var_pop(lng).alias(f"{end}_var_lng"),
            F.covar_pop(lat, lng).alias(f"{end}_cov"),
        ]
    n1, n2 = F.col("pickup_n"), F.col("dropoff_n")
    n = n1 + n2

    def pooled(name: str):
        return (n1 * F.col(f"pickup_{name}") + n2 * F.col(f"dropoff_{name}")) / n

    between = n1 * n2 / (n * n)
    gap_lat = F.col("pickup_lat") - F.col("dropoff_lat")
    gap_lng = F.col("pickup_lng") - F.col("dropoff_lng")
    spread = pooled("var_lat") - pooled("var_lng") + between * (gap_lat * gap_lat - gap_lng * gap_lng)
    cov = pooled("cov") + between * gap_lat * gap_lng
    angle = F.atan2(2 * cov, spread) / 2
    return df.agg(*aggregates).select(
        F.struct(
            pooled("lat").alias("lat"),
            pooled("lng").alias("lng"),
            F.cos(angle).alias("cos"),
            F.sin(angle).alias("sin"),
            F.when(F.sin(angle) > 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("side"),
        ).alias("axes")
    )


def with_distances(
    df: DataFrame, first: str = "latitude", second: str = "longitude", prefix: str = "lat_long_"
) -> DataFrame:
    """Distances, direction and centre between pickup and dropoff in the named coordinate pair.

    With ``pca0``/``pca1`` the rotated units are read as degrees; that defines the feature.
    """
    ends = [F.col(f"{end}_{axis}") for end in ("pickup", "dropoff") for axis in (first, second)]
    return df.withColumns(
        {
            f"{prefix}distance_haversine": geo.haversine_km(*ends),
            f"{prefix}distance_dummy_manhattan": geo.manhattan_km(*ends),
            f"{prefix}direction": geo.bearing_degrees(*ends),
            f"{prefix}center_latitude": geo.midpoint(ends[0], ends[2]),
            f"{prefix}center_longitude": geo.midpoint(ends[1], ends[3]),
        }
    )


def with_location_bins(
    df: DataFrame,
    first: str = "latitude",
    second: str = "longitude",
    prefix: str = "lat_long_",
    digits: int = 2,
) -> DataFrame:
    sources = [f"{end}_{axis}" for end in ("pickup", "dropoff") for axis in (first, second)]
    sources += [f"{prefix}center_latitude", f"{prefix}center_longitude"]
    return df.withColumns({f"{c}_bin": geo.location_bin(F.col(c), digits) for c in sources})


def with_great_circle_miles(df: DataFrame) -> DataFrame:
    """Great-circle miles under the column name the models know."""
    return df.withColumn(
        "osmnx_distance",
        geo.great_circle_miles(
            F.col("pickup_latitude"),
            F.col("pickup_longitude"),
            F.col("dropoff_latitude"),
            F.col("dropoff_longitude"),
        ),
    )


def with_binary_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_passenger_alone": F.when(F.col("passenger_count") == 1, 1).otherwise(0),
            "is_midnight": calendar.is_midnight(F.col("pickup_hour")),
        }
    )


def with_holidays(df: DataFrame) -> DataFrame:
    parts = F.col("pickup_month"), F.col("pickup_day"), F.col("pickup_weekday")
    return df.withColumns(
        {
            "is_holyday": calendar.is_holiday(*parts),
            "is_day_before_holyday": calendar.is_holiday_eve(*parts),
        }
    )


def with_targets(df: DataFrame, prefix: str = "lat_long_") -> DataFrame:
    """The three targets whose group means become features; NULL wherever duration is."""
    seconds = F.col("trip_duration")
    return df.withColumns(
        {
            f"{prefix}avg_speed_h": geo.speed(F.col(f"{prefix}distance_haversine"), seconds),
            f"{prefix}avg_speed_m": geo.speed(F.col(f"{prefix}distance_dummy_manhattan"), seconds),
            "log_trip_duration": F.log1p(seconds),
        }
    )


def bounding_box(df: DataFrame) -> DataFrame:
    """Smallest box holding all pickups and dropoffs."""

    def over_both_ends(pick, aggregate, axis):
        return pick(aggregate(f"pickup_{axis}"), aggregate(f"dropoff_{axis}"))

    return df.agg(
        over_both_ends(F.least, F.min, "latitude").alias("min_latitude"),
        over_both_ends(F.greatest, F.max, "latitude").alias("max_latitude"),
        over_both_ends(F.least, F.min, "longitude").alias("min_longitude"),
        over_both_ends(F.greatest, F.max, "longitude").alias("max_longitude"),
    )
