"""Row-level preparation: stacking splits, casting, filtering, sampling and splitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripworks.functions.numeric import array_constant, hash_bucket, numeric_id
from tripworks.functions.text import flag_from_letter
from tripworks.sources.schema import TEST, TRAIN
from tripworks.sources.scratch import materialise

# Fixed values. Unsigned bytes need a short in Spark, whose byte ends at 127.
NARROW_TYPES: Mapping[str, str] = {
    "is_store_and_fwd_flag": "smallint",
    "passenger_count": "smallint",
    "vendor_id": "smallint",
    "pickup_month": "smallint",
    "pickup_day": "smallint",
    "pickup_hour": "smallint",
    "pickup_weekofyear": "smallint",
    "pickup_weekday": "smallint",
    "is_weekend": "smallint",
    "trip_duration": "bigint",
}


def stack_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    """Train over test, matched by column name; what only train has is NULL for test."""
    return train.withColumn("split", F.lit(TRAIN)).unionByName(
        test.withColumn("split", F.lit(TEST)), allowMissingColumns=True
    )


def only_split(df: DataFrame, split: str) -> DataFrame:
    return df.where(F.col("split") == split)


def encode_flag(df: DataFrame) -> DataFrame:
    """Replace the stored-and-forwarded letter by a 0/1 flag."""
    return df.withColumn("is_store_and_fwd_flag", flag_from_letter(F.col("store_and_fwd_flag"))).drop(
        "store_and_fwd_flag"
    )


def narrow_types(df: DataFrame, types: Mapping[str, str] = NARROW_TYPES) -> DataFrame:
    """Cast the listed columns that are present, in both splits."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})


def filter_outliers(
    df: DataFrame,
    distance: str = "lat_long_distance_haversine",
    duration: str = "trip_duration",
    max_distance: float | None = None,
    max_duration: float | None = None,
) -> DataFrame:
    """Keep trips below the given bounds. Without bounds nothing is filtered."""
    if max_distance is not None:
        df = df.where(F.col(distance) < max_distance)
    if max_duration is not None:
        df = df.where(F.col(duration) < max_duration)
    return df


def select_anomalies(df: DataFrame, condition: Column, columns: Sequence[str]) -> DataFrame:
    return df.where(condition).select(*columns)


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str] = ("id",)) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keep})


def with_numeric_id(df: DataFrame, source: str = "id", target: str = "id") -> DataFrame:
    return df.withColumn(target, numeric_id(F.col(source)))


def systematic_sample(df: DataFrame, step: int, key: str = "id") -> DataFrame:
    """Every ``step``-th row by the number in the id, which needs no global row order."""
    return df.where(F.pmod(numeric_id(F.col(key)), F.lit(step)) == 0)


def with_row_numbers(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number all rows from 1 in a stated order, nulls first; rows equal in it come in any order.

    Rows are dealt by range, each range is numbered in a task of its own, and what lies in the ranges
    before it, one number per range, is added. No task sees more than its range.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = {r["_range"]: r["count"] for r in dealt.groupBy("_range").count().collect()}  # at most one row per range
    before = [0]
    for k in range(parts):
        before.append(before[-1] + counts.get(k, 0))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)).cast("bigint")
    return dealt.withColumn(name, place + F.element_at(array_constant(before, "bigint"), F.col("_range") + 1)).drop("_range")


def every_nth(df: DataFrame, step: int, order: Sequence[str], start: int = 0) -> DataFrame:
    """Exactly every ``step``-th row of a stated order, from row number ``start`` (counted from 0) on."""
    return with_row_numbers(df, order, "_number").where(F.pmod(F.col("_number") - 1 - start, F.lit(step)) == 0).drop("_number")


def holdout_split(df: DataFrame, train_share: float = 0.75, seed: int = 42, key: str = "id") -> DataFrame:
    """Mark each row ``fit`` or ``holdout`` by a hash of its id."""
    bucket = hash_bucket(F.col(key), seed, 10_000)
    return df.withColumn("part", F.when(bucket < round(train_share * 10_000), "fit").otherwise("holdout"))


def assign_folds(df: DataFrame, folds: int = 5, seed: int = 42, key: str = "id") -> DataFrame:
    return df.withColumn("fold", hash_bucket(F.col(key), seed, folds))


def shuffle_rows(df: DataFrame, seed: int, key: str = "id") -> DataFrame:
    """Repeatable random order. It is a full sort, so use it only before an output read in order."""
    return df.orderBy(hash_bucket(F.col(key), seed, 2**31 - 1), F.col(key))


def fill_missing_with_zero(df: DataFrame) -> DataFrame:
    """0 for missing values of every numeric column; text and times have no zero."""
    return df.fillna(0)


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows of a stated order."""
    return df.orderBy(*order).limit(n)
