"""Route and weather features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripworks.functions.calendar import day_month_date
from tripworks.functions.numeric import ratio
from tripworks.functions.text import STEP_WORDS, count_word, measured_or_trace
from tripworks.sources.schema import ROUTE_STEP_COLUMNS, WEATHER_COLUMNS
from tripworks.sources.scratch import materialise

TRACED_COLUMNS = ("precipitation", "snow_fall", "snow_depth")


def join_routes(df: DataFrame, *routes: DataFrame) -> DataFrame:
    """Left join one or more route tables by trip id. Ids are unique, so hashing them spreads evenly."""
    for table in routes:
        df = df.join(table, "id", "left")
    return df


def with_step_ratios(df: DataFrame) -> DataFrame:
    steps = F.col("number_of_steps")
    return df.withColumns(
        {
            "per_step_distance": ratio(F.col("total_distance"), steps),
            "per_travel_time": ratio(F.col("total_travel_time"), steps),
        }
    )


def with_step_counts(df: DataFrame, words=STEP_WORDS) -> DataFrame:
    return df.withColumns({f"steps_{w}_count": count_word(F.col("step_direction"), w) for w in words})


def drop_route_steps(df: DataFrame, prefixes=("",)) -> DataFrame:
    return df.drop(*(f"{p}{c}" for p in prefixes for c in ROUTE_STEP_COLUMNS))


def daily_weather(weather: DataFrame, year: int | None = None) -> DataFrame:
    """One row per day: the text date made a date, trace marks made numbers.

    Readings of a day that occurs more than once are averaged; rows whose date cannot be read are
    left out (see ``unparsed_days``). ``year`` takes the place of the year in the text.
    """
    readings = [c for c in WEATHER_COLUMNS if c in weather.columns]
    numbers = weather.select(
        day_month_date(F.col("date"), year).alias("pickup_date"),
        *(
            (measured_or_trace(F.col(c)) if c in TRACED_COLUMNS else F.col(c).try_cast("double")).alias(c)
            for c in readings
        ),
    )
    known = numbers.where(F.col("pickup_date").isNotNull())
    return known.groupBy("pickup_date").agg(*(F.avg(c).alias(c) for c in readings))


def unparsed_days(weather: DataFrame) -> DataFrame:
    """Rows of the weather table whose date is missing or not ``d-m-yyyy``."""
    return weather.where(day_month_date(F.col("date")).isNull())


def join_weather(
    df: DataFrame, weather: DataFrame, keep: tuple[str, ...] = ("snow_fall",), year: int | None = None
) -> DataFrame:
    """Left join the day's weather by pickup date, keeping only the wanted readings.

    The daily table is written first, so that its size is known when the join is planned.
    """
    daily = materialise(daily_weather(weather, year).select("pickup_date", *keep), "daily-weather")
    return (
        df.withColumn("pickup_date", F.to_date("pickup_datetime")).join(daily, "pickup_date", "left").drop("pickup_date")
    )
