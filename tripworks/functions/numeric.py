"""Arithmetic helpers shared by the other functions and operators."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def round_half_even(value: Column, digits: int) -> Column:
    """Round to ``digits`` decimals, ties to even (``F.round`` would take ties away from zero)."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero denominator instead of failing under ANSI mode."""
    return F.try_divide(numerator, denominator)


def hash_bucket(key: Column, seed: int, buckets: int) -> Column:
    """Bucket 0..buckets-1 that depends only on the key and the seed.

    The hash is the first 32 bits of an MD5, so any engine and any partitioning gives a row the
    same bucket, also when a lost task runs again.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(buckets)).cast("int")


def numeric_id(trip_id: Column) -> Column:
    """The number behind the two-letter prefix of a trip id."""
    return F.substring(trip_id, 3, 2147483647).cast("bigint")


def log_target(seconds: Column) -> Column:
    return F.log(seconds)


def log1p_target(seconds: Column) -> Column:
    return F.log1p(seconds)


def from_log_target(log_seconds: Column) -> Column:
    return F.exp(log_seconds)


def array_constant(values: Sequence, kind: str) -> Column:
    """An array constant, read from one string: no expression per element."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")
