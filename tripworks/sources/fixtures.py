"""Trips, routes and weather derived from the given star-schema tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SOUTH, WEST = 40.63, -74.03


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _trip_id(key: Column) -> Column:
    # Seven digits at least; larger keys keep all their digits, so ids stay unique at any scale.
    text = key.cast("string")
    return F.concat(F.lit("id"), F.lpad(text, F.greatest(F.lit(7), F.length(text)), F.lit("0")))


def _scatter(key: Column, origin: float, a: int, b: int, size: int) -> Column:
    spread = F.pmod(key * a, F.lit(size)) * F.pmod(key * b, F.lit(size))
    return F.lit(origin) + spread.cast("double") / F.lit(10000.0)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price, date = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderdate")
    is_train = key % 10 < 7
    duration = 60 + F.floor(price).cast("bigint") % 3600
    start = (key * 7919) % 86400

    def after_midnight(seconds: Column) -> Column:
        return date + F.make_dt_interval(secs=seconds)

    return table(spark, sf_dir, "orders").select(
        _trip_id(key).alias("id"),
        F.when(is_train, "train").otherwise("test").alias("split"),
        (1 + F.col("o_custkey") % 2).alias("vendor_id"),
        after_midnight(start).alias("pickup_datetime"),
        F.when(is_train, after_midnight(start + duration)).alias("dropoff_datetime"),
        F.when(key % 97 != 0, 1 + key % 6).alias("passenger_count"),
        _scatter(key, SOUTH, 7919, 104729, 47).alias("pickup_latitude"),
        _scatter(key, WEST, 6151, 3571, 53).alias("pickup_longitude"),
        _scatter(key, SOUTH, 3571, 6151, 47).alias("dropoff_latitude"),
        _scatter(key, WEST, 104729, 7919, 53).alias("dropoff_longitude"),
        F.when(key % 89 != 0, F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N")).alias("store_and_fwd_flag"),
        F.when(is_train, duration).alias("trip_duration"),
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    key = F.col("l_orderkey")
    turns = F.concat(
        F.expr("repeat('left|', cast(l_orderkey % 4 as int))"),
        F.expr("repeat('slight right|', cast(l_orderkey % 3 as int))"),
        F.lit("straight|none"),
    )
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(
            F.min("p_brand").alias("starting_street"),
            F.max("p_brand").alias("end_street"),
            F.sum("l_quantity").alias("total_distance"),
            (F.sum(F.col("l_linenumber").cast("bigint")) * 30).alias("total_travel_time"),
            F.count(F.lit(1)).alias("number_of_steps"),
        )
        .select(
            _trip_id(key).alias("id"),
            "starting_street",
            "end_street",
            "total_distance",
            "total_travel_time",
            "number_of_steps",
            turns.alias("step_direction"),
        )
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather of all days with orders: one row per day however many orders there are."""
    date = F.col("o_orderdate")
    day = F.dayofmonth(date)

    def reading(every: int, value: Column) -> Column:
        return F.when(day % every == 0, "T").otherwise(value)

    return (
        table(spark, sf_dir, "orders")
        .select(
            F.concat_ws("-", day.cast("string"), F.month(date).cast("string"), F.year(date).cast("string")).alias("date"),
            reading(6, F.concat(F.lit("0."), (day % 10).cast("string"))).alias("precipitation"),
            reading(7, (day % 5).cast("string")).alias("snow_fall"),
            reading(11, (day % 3).cast("string")).alias("snow_depth"),
        )
        .distinct()
    )
