"""Data profiling, drift checks, distributions and imputation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, log, pi, sqrt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tripworks.functions.numeric import round_half_even
from tripworks.sources.schema import TEST, TRAIN


def _long(wide: DataFrame, key: str, rows: dict[str, dict[str, Column]]) -> DataFrame:
    """Turn one wide row of aggregates into one row per entry of ``rows``."""
    entries = [
        F.struct(F.lit(name).alias(key), *(column.alias(field) for field, column in fields.items()))
        for name, fields in rows.items()
    ]
    return wide.select(F.inline(F.array(*entries)))


def missing_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values, their number and share, worst first. One scan for all columns."""
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *counts)
    rows = {
        c: {"missing_count": F.col(f"m{i}"), "missing_rate": F.try_divide(F.col(f"m{i}"), F.col("rows"))}
        for i, c in enumerate(df.columns)
    }
    return (
        _long(wide, "column_name", rows)
        .where(F.col("missing_count") > 0)
        .orderBy(F.desc("missing_count"), "column_name")
    )


def drop_sparse_columns(df: DataFrame, max_missing_rate: float = 0.9, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns whose share of missing values is above the limit; the list has one row per column."""
    sparse = missing_profile(df).where(F.col("missing_rate") > max_missing_rate).select("column_name").collect()
    return df.drop(*(r["column_name"] for r in sparse if r["column_name"] not in keep))


def drift_profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean, spread and missing share per feature in train and test, and how far they lie apart.

    Conditional aggregates over one scan replace stacking every feature of every row. Both
    differences are taken from the rounded columns.
    """
    aggregates = []
    for split in (TRAIN, TEST):
        here = F.col("split") == split
        aggregates.append(F.count_if(here).alias(f"{split}_rows"))
        for i, feature in enumerate(features):
            value = F.when(here, F.col(f"`{feature}`").cast("double"))
            aggregates += [
                F.avg(value).alias(f"{split}_mean_{i}"),
                F.stddev_pop(value).alias(f"{split}_std_{i}"),
                F.count(value).alias(f"{split}_n_{i}"),
            ]
    rows = {}
    for i, feature in enumerate(features):
        fields = {}
        for statistic in ("mean", "std"):
            for split in (TRAIN, TEST):
                fields[f"{split}_{statistic}"] = round_half_even(F.col(f"{split}_{statistic}_{i}"), 4)
        for split in (TRAIN, TEST):
            share = 1 - F.try_divide(F.col(f"{split}_n_{i}"), F.col(f"{split}_rows"))
            fields[f"{split}_nan"] = round_half_even(share, 3)
        rows[feature] = fields
    apart = F.abs(F.col("train_mean") - F.col("test_mean"))
    spread = F.abs(F.col("train_std") + F.col("test_std"))
    return _long(df.agg(*aggregates), "feature", rows).withColumns(
        {
            "train_test_mean_diff": F.try_divide(apart, spread) * 2,
            "train_test_nan_diff": F.abs(F.col("train_nan") - F.col("test_nan")),
        }
    )


def worst_drift(profile: DataFrame, by: str = "train_test_mean_diff", n: int = 5) -> DataFrame:
    return profile.orderBy(F.desc_nulls_last(by), "feature").limit(n)


def check_before_modelling(df: DataFrame, features: Sequence[str]) -> dict[str, DataFrame]:
    """The reports to look at before fitting a model."""
    drift = drift_profile(df, features)
    return {
        "train_missing": missing_profile(df.where(F.col("split") == TRAIN)),
        "test_missing": missing_profile(df.where(F.col("split") == TEST)),
        "mean_drift": worst_drift(drift, "train_test_mean_diff"),
        "nan_drift": worst_drift(drift, "train_test_nan_diff"),
        "drift": drift,
    }


# --- distributions --------------------------------------------------------------------------------

# Values of one rank's bracket that may meet in one task to be sorted out exactly.
FEW_VALUES = 10_000
_SKETCH_ACCURACY = 10_000


@dataclass
class _Search:
    """The search for one rank of one column: all that is left lies strictly between two values."""

    value: Column
    rank: int  # among the values left, from 0
    left: int
    low: float | None = None
    high: float | None = None
    found: float | None = None

    def inside(self) -> Column:
        """The value where it is still looked at, else NULL."""
        here = self.value.isNotNull()
        if self.low is not None:
            here = here & (self.value > self.low)
        if self.high is not None:
            here = here & (self.value < self.high)
        return F.when(here, self.value)


def _ranks(df: DataFrame, searches: Sequence[_Search], few: int) -> None:
    """Find all ranks of all columns together; the number of passes does not depend on how many.

    A round brackets each open rank by a sketch of what is left for it, then counts exactly what lies
    below, at, between and above the bracket's ends. A poor sketch costs a round but never the
    result, and a value that fills a column ends its search. Once at most ``few`` values are left,
    they are sorted. The driver holds a handful of numbers per rank.
    """
    while True:
        open_ = [s for s in searches if s.found is None]
        if not open_:
            return
        aims = []
        for s in open_:
            share, slack = s.rank / max(s.left - 1, 1), 2.0 / _SKETCH_ACCURACY
            if s.left <= few:
                aims.append(F.element_at(F.array_sort(F.collect_list(s.inside())), s.rank + 1))
            else:
                ends = [max(0.0, share - slack), min(1.0, share + slack)]
                aims.append(F.percentile_approx(s.inside(), ends, _SKETCH_ACCURACY))
        answers = df.agg(*(a.alias(f"a{i}") for i, a in enumerate(aims))).first()
        brackets = []
        for s, answer in zip(open_, answers):
            if s.left <= few:
                s.found = answer
            else:
                brackets.append((s, *answer))
        if not brackets:
            continue
        counts = []
        for s, low, high in brackets:
            v = s.inside()
            zones = (v < low, v == low, (v > low) & (v < high), (v == high) & (v > low))
            counts += [F.count_if(zone) for zone in zones]
        numbers = df.agg(*(c.alias(f"c{i}") for i, c in enumerate(counts))).first()
        for i, (s, low, high) in enumerate(brackets):
            below, at_low, between, at_high = numbers[4 * i : 4 * i + 4]
            above = s.left - below - at_low - between - at_high
            for size, step in (
                (below, {"high": low}), (at_low, {"found": low}), (between, {"low": low, "high": high}),
                (at_high, {"found": high}), (above, {"low": high}),
            ):
                if s.rank < size:
                    for name, value in step.items():
                        setattr(s, name, value)
                    s.left = size
                    break
                s.rank -= size


def exact_percentiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], few: int = FEW_VALUES
) -> dict[str, list[float | None]]:
    """Percentiles of each column with linear interpolation, equal to ``percentile`` but safe at any size."""
    values = {c: F.col(f"`{c}`").cast("double") for c in columns}
    rows = df.agg(*(F.count(v).alias(f"n{i}") for i, v in enumerate(values.values()))).first()
    wanted: dict[tuple[str, int], _Search] = {}
    for (column, value), n in zip(values.items(), rows):
        for share in shares if n else ():
            place = share * (n - 1)
            for rank in {int(place), min(int(place) + 1, n - 1)}:
                wanted[column, rank] = _Search(value, rank, n)
    _ranks(df, list(wanted.values()), few)
    result = {}
    for column, n in zip(columns, rows):
        found = []
        for share in shares:
            if not n:
                found.append(None)
                continue
            place = share * (n - 1)
            low, high = wanted[column, int(place)].found, wanted[column, min(int(place) + 1, n - 1)].found
            found.append(low + (high - low) * (place - int(place)))
        result[column] = found
    return result


def describe(df: DataFrame, columns: Sequence[str], few: int = FEW_VALUES) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, one row per statistic."""
    quartiles = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
    found = exact_percentiles(df, columns, list(quartiles.values()), few)
    aggregates, entries = [], []
    for i, column in enumerate(columns):
        value = F.col(f"`{column}`").cast("double")
        aggregates += [
            F.count(value).cast("double").alias(f"count{i}"),
            F.avg(value).alias(f"mean{i}"),
            F.stddev_samp(value).alias(f"std{i}"),
            F.min(value).alias(f"min{i}"),
            F.max(value).alias(f"max{i}"),
        ]
        values = {s: F.col(f"{s}{i}") for s in ("count", "mean", "std", "min")}
        values |= {q: F.lit(v).cast("double") for q, v in zip(quartiles, found[column])}
        values["max"] = F.col(f"max{i}")
        entries += [
            F.struct(F.lit(column).alias("column_name"), F.lit(s).alias("statistic"), v.alias("value")) for s, v in values.items()
        ]
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def counts_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("cnt"))


def counts_by_category(df: DataFrame, levels: Sequence[Sequence[str]]) -> DataFrame:
    """Row counts for several category columns (or pairs) in one scan, in long form.

    A missing value counts as no category.
    """
    from tripworks.operators.stats import group_means_by_level

    return group_means_by_level(df, levels, {})


def histogram(df: DataFrame, value: Column, width: float, low: float = 0.0) -> DataFrame:
    """Fixed-width bins: lower edge and number of rows."""
    index = F.floor((value - F.lit(float(low))) / F.lit(float(width)))
    return (
        df.where(value.isNotNull())
        .groupBy(index.cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select("bin", (F.lit(float(low)) + F.col("bin") * F.lit(float(width))).alias("bin_from"), "cnt")
    )


# Widths of the kernel beyond which it adds nothing that is counted.
KERNEL_REACH = 5.0


def density(
    df: DataFrame, value: Column, low: float, high: float, bins: int, width: float, by: Sequence[str] = ()
) -> DataFrame:
    """Gaussian kernel density at the middles of ``bins`` bins from ``low`` to ``high``: (by, point, density).

    Values are counted per bin first, and each bin then adds its share to the points within
    ``KERNEL_REACH`` kernel widths, so what is summed are bins and not rows. A value moves by half a bin at
    most, so the density is off by at most bin / 2 times the kernel's steepest slope, 0.242 / width^2,
    plus what lies beyond the reach, under 6e-7 of the kernel's mass. Missing values and those outside
    of the bins count in the total but add nothing.
    """
    step = (high - low) / bins
    reach = ceil(KERNEL_REACH * width / step)
    index = F.floor((value - F.lit(float(low))) / F.lit(step)).cast("int")
    counts = df.where(value.isNotNull()).groupBy(*by, index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*by).agg(F.sum("n").alias("total"))
    inside = counts.where((F.col("bin") >= 0) & (F.col("bin") < bins))
    spread = inside.select(*by, "bin", "n", F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("away"))
    spread = spread.withColumn("at", F.col("bin") + F.col("away")).where((F.col("at") >= 0) & (F.col("at") < bins))
    u = F.col("away") * F.lit(step / width)
    kernel = F.exp(-u * u / 2) / F.lit(width * sqrt(2 * pi))
    sums = spread.groupBy(*by, "at").agg(F.sum(F.col("n") * kernel).alias("sum"))
    joined = sums.join(totals, list(by)) if by else sums.join(F.broadcast(totals))  # without groups one row
    return joined.select(*by, (F.lit(float(low)) + (F.col("at") + 0.5) * F.lit(step)).alias("point"), (F.col("sum") / F.col("total")).alias("density"))


def threshold_counts(df: DataFrame, duration: str = "trip_duration") -> DataFrame:
    seconds = F.col(duration)
    return df.agg(
        F.count_if(seconds <= 1).alias("up_to_1s"),
        F.count_if(seconds <= 10).alias("up_to_10s"),
        F.count_if(seconds > 100 * 3600).alias("over_100h"),
    )


def duration_range(df: DataFrame, duration: str = "trip_duration") -> DataFrame:
    return df.agg(
        F.floor(F.max(duration) / F.lit(3600)).cast("bigint").alias("max_hours"), F.min(duration).alias("min_seconds")
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


# --- imputation -----------------------------------------------------------------------------------


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value that is not missing, the smallest if several are; one row at most."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), column)
        .limit(1)
    )


def impute_most_frequent(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), most_frequent(df, column).select(column).scalar()))


def impute_constant(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


_SKETCH_ERROR = 0.05
_SKETCH_REGISTERS = 512  # what Spark uses for that error
# Up to half as many values as registers leave half of them empty. The sketch then counts by empty
# registers, and its estimate is at most registers * ln 2, which is within the range (400) in which it does.
SKETCHED = _SKETCH_REGISTERS // 2


def low_cardinality_columns(df: DataFrame, max_distinct: int = 10) -> list[str]:
    """Numeric columns with at most ``max_distinct`` values, exactly.

    Up to ``SKETCHED``, a sketch rules out the columns with many values first. It cannot rule out a
    wanted one: so few values touch at most as many registers, which caps the estimate. Above, all
    numeric columns are counted exactly.
    """
    maybe = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    if maybe and max_distinct <= SKETCHED:
        cap = ceil(_SKETCH_REGISTERS * log(_SKETCH_REGISTERS / (_SKETCH_REGISTERS - max_distinct))) + 1
        estimates = df.agg(*(F.approx_count_distinct(f"`{c}`", _SKETCH_ERROR).alias(c) for c in maybe)).first()
        maybe = [c for c in maybe if estimates[c] <= cap]
    if not maybe:
        return []
    exact = df.agg(*(F.count_distinct(f"`{c}`").alias(c) for c in maybe)).first()
    return [c for c in maybe if exact[c] <= max_distinct]


def impute_low_cardinality(df: DataFrame, max_distinct: int = 10, value: int = -1) -> DataFrame:
    """Fill and narrow numeric columns that are categories in disguise.

    A value outside a signed byte becomes NULL rather than wrapping around.
    """
    columns = low_cardinality_columns(df, max_distinct)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)).try_cast("tinyint") for c in columns})
