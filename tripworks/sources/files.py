"""Readers for trips, routes, weather and accidents in CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tripworks.operators.rows import prefix_columns, stack_splits
from tripworks.sources import schema

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _whole_number(text: Column) -> Column:
    """Text to bigint; ``1.0`` is how integer columns with gaps are often written. Fractions are an error."""
    number = text.try_cast("double")
    whole = F.coalesce(text.try_cast("bigint"), F.when(number == F.floor(number), number.cast("bigint")))
    bad = F.raise_error(F.concat(F.lit("not a whole number: "), text))
    missing = text.isNull() | F.isnan(F.coalesce(number, F.lit(0.0)))
    return F.when(missing, F.lit(None)).when(whole.isNotNull(), whole).otherwise(bad).cast("bigint")


def _try_typed(text: Column, kind: T.DataType) -> Column:
    """Like ``_typed``, but NULL for what cannot be read."""
    if isinstance(kind, T.TimestampNTZType):
        return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT)).cast("timestamp_ntz")
    if isinstance(kind, T.LongType):
        number = text.try_cast("double")
        return F.coalesce(text.try_cast("bigint"), F.when(number == F.floor(number), number.cast("bigint")))
    return text.try_cast(kind)


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        return F.to_timestamp_ntz(text, F.lit(TIMESTAMP_FORMAT))
    return _whole_number(text) if isinstance(kind, T.LongType) else text.cast(kind)


def _by_header(spark: SparkSession, paths: str | Sequence[str], declared: T.StructType) -> DataFrame:
    """Read columns by header name, whatever their order, and cast them to the declared types."""
    files = [paths] if isinstance(paths, str) else list(paths)
    # Without a schema, only the header line is looked at and every column is text.
    parts = [spark.read.option("header", True).csv(path) for path in files]
    picked = [
        part.select(*(_typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in declared)) for part in parts
    ]
    whole = picked[0]
    for part in picked[1:]:
        whole = whole.unionByName(part)
    return schema.nan_to_null(whole)


def read_checked(spark: SparkSession, paths: str | Sequence[str], declared: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The rows that can be read, by header like the other readers, and those that cannot: (file, line, reasons).

    A row is bad if a value is there but is not of its column's type, each a reason ``column: value``, or
    if the line has more or fewer fields than the header, the reason being ``fields``. Each row of the
    files is in exactly one of the two. ``nan`` is a missing number.
    """
    files = [paths] if isinstance(paths, str) else list(paths)
    good = bad = None
    for path in files:
        names = spark.read.option("header", True).csv(path).columns
        raw = T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField("_corrupt", T.StringType())])
        lines = spark.read.option("header", True).option("columnNameOfCorruptRecord", "_corrupt").schema(raw).csv(path)
        typed = {f.name: _try_typed(F.col(f"`{f.name}`"), f.dataType) for f in declared}

        def wrong(f: T.StructField, typed=typed) -> Column:
            text = F.col(f"`{f.name}`")
            missing = text.isNull() | (F.lower(F.trim(text)) == "nan")
            return F.when(~missing & typed[f.name].isNull(), F.concat(F.lit(f"{f.name}: "), text))

        reasons = F.array(F.when(F.col("_corrupt").isNotNull(), F.lit("fields")), *map(wrong, declared))
        line = F.coalesce("_corrupt", F.concat_ws(",", *(F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names)))
        marked = lines.select(
            *(c.alias(n) for n, c in typed.items()),
            F.col("_metadata.file_path").alias("_file"),
            line.alias("_text"),
            F.filter(reasons, lambda r: r.isNotNull()).alias("_reasons"),
        )
        read = schema.nan_to_null(marked.where(F.size("_reasons") == 0).select(*typed))
        left = marked.where(F.size("_reasons") > 0).select(F.col("_file").alias("file"), F.col("_text").alias("line"), F.col("_reasons").alias("reasons"))
        good, bad = (read, left) if good is None else (good.unionByName(read), bad.unionByName(left))
    return good, bad


def read_trips(spark: SparkSession, train_paths, test_paths) -> DataFrame:
    """Raw train and test trips in one frame told apart by ``split``."""
    return stack_splits(
        _by_header(spark, train_paths, schema.TRAIN_TRIPS), _by_header(spark, test_paths, schema.TEST_TRIPS)
    )


def read_routes(spark: SparkSession, paths) -> DataFrame:
    """Fastest routes; the parts of the train file and the test file may be given together."""
    return _by_header(spark, paths, schema.ROUTES)


def read_second_routes(spark: SparkSession, paths) -> DataFrame:
    """Second fastest routes: the route columns with a prefix, so both kinds can meet in one row."""
    return prefix_columns(read_routes(spark, paths), "second_", keep=("id",))


def read_weather(spark: SparkSession, paths) -> DataFrame:
    """Daily weather as text columns, named by position."""
    files = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.option("header", True).csv(files).toDF(*schema.WEATHER.names)


def read_accidents(spark: SparkSession, paths) -> DataFrame:
    """Accident reports, reduced to the number of injured persons."""
    return _by_header(spark, paths, T.StructType([T.StructField(schema.INJURED, T.LongType())]))
