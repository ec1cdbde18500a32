"""Left joins that attach looked-up columns to trips without a hot key filling one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

# A lookup of up to this many bytes, by its rows and the default size of their types, is broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024
# Rows of one key that may meet in one task of a shuffle join; a key with more is cut into slices.
# There are at most (rows / SLICE_ROWS) such keys, so their list stays short whatever the data.
SLICE_ROWS = 2_000_000


def _row_bytes(df: DataFrame) -> int:
    return df._jdf.schema().defaultSize()


def fits_broadcast(lookup: DataFrame, rows: int | None) -> bool:
    """Whether a lookup of at most ``rows`` rows is small enough to send to every task."""
    return rows is not None and rows * _row_bytes(lookup) <= BROADCAST_BYTES


def attach(
    df: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    *,
    rows: int | None = None,
    spread: str = "id",
    key_counts: DataFrame | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Left join ``lookup`` on ``keys``. ``rows`` is a proven or measured bound on its size.

    Rows whose key is missing never match and get NULL, like keys not in the lookup. For a large
    lookup, ``key_counts`` may hold the rows of ``df`` per key in ``_rows`` if they are known.
    """
    if fits_broadcast(lookup, rows):
        return df.join(F.broadcast(lookup), list(keys), "left")
    if key_counts is None:
        key_counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return _attach_sliced(df, lookup, list(keys), spread, key_counts, slice_rows)


def _attach_sliced(
    df: DataFrame, lookup: DataFrame, keys: list[str], spread: str, key_counts: DataFrame, slice_rows: int
) -> DataFrame:
    """Shuffle join where heavy keys are cut into slices and missing keys are scattered.

    A row of a heavy key goes to the slice its ``spread`` column hashes to, and the one lookup row
    of that key is repeated once per slice.
    """
    heavy = F.broadcast(
        key_counts.where(F.col("_rows") > slice_rows).select(
            *keys, F.ceil(F.col("_rows") / F.lit(slice_rows)).cast("int").alias("_slices")
        )
    )
    no_slice = F.array(F.lit(0))
    sliced_lookup = (
        lookup.join(heavy, keys, "left")
        .withColumn("_slice", F.explode(F.coalesce(F.sequence(F.lit(1), F.col("_slices")), no_slice)))
        .drop("_slices")
    )
    key_missing = reduce(or_, (F.col(k).isNull() for k in keys))
    scatter = F.xxhash64(F.col(spread))
    sliced = df.join(heavy, keys, "left").withColumn(
        "_slice",
        F.when(key_missing, -1 - F.pmod(scatter, F.lit(1 << 30)).cast("int"))
        .when(F.col("_slices").isNotNull(), 1 + F.pmod(scatter, F.col("_slices")).cast("int"))
        .otherwise(0),
    )
    return sliced.join(sliced_lookup, [*keys, "_slice"], "left").drop("_slice", "_slices")
