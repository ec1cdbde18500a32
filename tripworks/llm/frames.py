"""Helpers of the corpus operators: reading tables, ranks and classes without a hot task."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tripworks.sources.scratch import materialise

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Texts are long: a batch of this many rows keeps the Python side of a task small.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the rows of an Arrow batch, and send functions of this package whole.

    Long texts make the default batch too big for small executors; and executors then need no copy
    of the package.
    """
    cloudpickle.register_pickle_by_value(sys.modules["tripworks.llm"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has the name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def row_key(df: DataFrame) -> Column:
    """128 bits over all columns: rows with one key are equal in every column, nulls included."""
    columns = [F.struct(*(F.col(f"`{c}`") for c in df.columns))]
    return F.concat(F.hex(F.xxhash64(*columns)), F.hex(F.xxhash64(F.lit(1), *columns)))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each key from 1 in the given order, nulls first. Written and read back once.

    Rows are dealt by range over keys and order, so a key with any share of the rows spreads over
    many tasks; each task numbers its own rows and adds what earlier ranges hold of the key. Only
    the first key of a range can continue an earlier one, so the list of what to add has at most
    one row per range and is broadcast. Rows equal in keys and order are told apart by where they
    were read; which of them gets which number does not matter to whoever orders by these columns.
    """
    part, here, tie, add = (free_name(df, n) for n in ("range_id", "rank_in_range", "read_at", "add"))
    n = partitions(df.sparkSession)
    cut = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(n, *keys, *order, tie)
    cut = materialise(cut.withColumn(part, F.spark_partition_id()), name)
    counts = cut.groupBy(*keys, part).agg(F.count(F.lit(1)).alias(add))
    before = W.partitionBy(*keys).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    carried = counts.select(*keys, part, F.sum(add).over(before).alias(add)).where(F.col(add) > 0)
    carried = materialise(carried, f"{name}-carried")
    numbered = cut.withColumn(
        here, F.row_number().over(W.partitionBy(part, *keys).orderBy(*order, tie)).cast("bigint")
    )
    matches = [numbered[k].eqNullSafe(carried[k]) for k in (part, *keys)]
    joined = numbered.join(F.broadcast(carried), matches, "left")
    rank = numbered[here] + F.coalesce(carried[add], F.lit(0))
    return joined.select(*(numbered[c] for c in df.columns), rank.alias(name))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, root) per node, root the least node.

    Alternating star contraction: each round links every larger neighbour of a node to the node's
    least neighbour, then every smaller one. Minima are combined before the shuffle and written, so that
    both sides of their join are plain shuffles, of which adaptive execution splits the hub's part.
    Rounds are written to the shared folder, and the last round leaves a star per component.
    """
    current = materialise(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    mark = _mark(current)
    while mark[0]:
        both = current.union(current.select("v", "u")).toDF("u", "v")
        least = materialise(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
        large = materialise(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large")
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        current = materialise(small.union(least).where("u <> v").distinct(), "edges")
        mark, last = _mark(current), mark
        if mark == last:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select("v", "v").distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Rows and checksum, to see whether a round changed anything."""
    checksum = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), checksum).first())
