"""Group statistics over training rows and their join back to all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tripworks.functions.numeric import ratio, round_half_even
from tripworks.operators.joins import attach, fits_broadcast
from tripworks.sources import schema
from tripworks.sources.scratch import materialise

TARGETS = ("lat_long_avg_speed_h", "lat_long_avg_speed_m", "log_trip_duration")


@dataclass(frozen=True)
class KeySet:
    """One grouping: its key columns, what to attach under which name, and how big it can get."""

    keys: tuple[str, ...]
    attach: Mapping[str, str] = field(hash=False)  # statistic -> feature column
    min_count: int = 0  # keep groups with more rows than this
    max_groups: int | None = None  # proven bound from the key domains, if there is one


def grouped(
    rows: DataFrame,
    key_sets: Sequence[KeySet],
    measures: Mapping[str, Column],
    sums: bool = False,
    through: Sequence[Sequence[str]] = (),
) -> DataFrame:
    """Row count and mean of every measure for all key sets, on request its sum and non-null count.

    Grouping sets share one scan and one shuffle of partial aggregates. Key sets within one of the
    column lists in ``through`` are derived from the groups of that list: there, rows are added up
    once, and only groups are repeated per key set. ``key_set`` numbers the grouping; keys that do
    not belong to it are NULL, and groups with a missing key are left out.
    """
    names = list(dict.fromkeys(k for s in key_sets for k in s.keys))
    if len({frozenset(s.keys) for s in key_sets}) != len(key_sets):
        raise ValueError("two key sets have the same columns")
    parts = ["n", *(f"{m}{part}" for m in measures for part in ("_sum", "_n"))]
    values = [F.lit(1).cast("bigint").alias("n")]
    for name, column in measures.items():
        values += [column.cast("double").alias(f"{name}_sum"), column.isNotNull().cast("bigint").alias(f"{name}_n")]
    columns = list(dict.fromkeys([*names, *(k for family in through for k in family)]))
    base = rows.select(*columns, *values)
    added_up = [F.sum(p).alias(p) for p in parts]
    kinds = dict(base.dtypes)

    families: dict[tuple[str, ...], list[int]] = {}
    for number, s in enumerate(key_sets):
        home = next((tuple(f) for f in through if set(s.keys) <= set(f)), ())
        families.setdefault(home, []).append(number)
    whole = None
    for family, numbers in families.items():
        source = base.groupBy(*family).agg(*added_up) if family else base
        part = _grouping_sets(source, {n: key_sets[n] for n in numbers}, added_up)
        missing = [k for k in names if k not in part.columns]
        part = part.select(*part.columns, *(F.lit(None).cast(kinds[k]).alias(k) for k in missing))
        whole = part if whole is None else whole.unionByName(part)

    keep = F.lit(False)
    for number, s in enumerate(key_sets):
        full = F.col("key_set") == number
        for key in s.keys:
            full = full & F.col(key).isNotNull()
        keep = keep | (full & (F.col("n") > s.min_count))
    shown = []
    for m in measures:
        shown.append(F.try_divide(f"{m}_sum", f"{m}_n").alias(m))
        shown += [f"{m}_sum", f"{m}_n"] if sums else []
    return whole.where(keep).select("key_set", *names, "n", *shown)


def _grouping_sets(rows: DataFrame, key_sets: Mapping[int, KeySet], aggregates: Sequence[Column]) -> DataFrame:
    """The aggregates of numbered key sets; keys that do not belong to a set are NULL."""
    if len(key_sets) == 1:
        number, only = next(iter(key_sets.items()))
        return rows.groupBy(*only.keys).agg(*aggregates).withColumn("key_set", F.lit(number))
    sets = [[F.col(k) for k in s.keys] for s in key_sets.values()]
    used = list(dict.fromkeys(k for s in key_sets.values() for k in s.keys))
    stats = rows.groupingSets(sets, *used).agg(F.grouping_id().alias("_gid"), *aggregates)
    gids = {
        sum(1 << (len(used) - 1 - i) for i, name in enumerate(used) if name not in s.keys): number
        for number, s in key_sets.items()
    }
    number_of = F.create_map(*(F.lit(v) for pair in gids.items() for v in pair))
    return stats.withColumn("key_set", number_of[F.col("_gid").cast("int")]).drop("_gid")


def group_means(
    rows: DataFrame, keys: Sequence[str], measures: Mapping[str, Column], min_count: int = 0
) -> DataFrame:
    """Plain report of one grouping: keys, row count and means."""
    aggregates = [F.avg(column).alias(name) for name, column in measures.items()]
    report = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"), *aggregates)
    return report.where(F.col("cnt") > min_count) if min_count else report


def group_means_by_level(
    rows: DataFrame, levels: Sequence[Sequence[str]], measures: Mapping[str, Column]
) -> DataFrame:
    """Several groupings in long form: ``level`` names the grouping, ``bucket`` its key values."""
    key_sets = [KeySet(tuple(level), {}) for level in levels]
    stats = grouped(rows, key_sets, measures)
    level, bucket = F.lit(None).cast("string"), F.lit(None).cast("string")
    for number, s in enumerate(key_sets):
        here = F.col("key_set") == number
        level = F.when(here, F.lit(",".join(s.keys))).otherwise(level)
        bucket = F.when(here, F.concat_ws(",", *(F.col(k).cast("string") for k in s.keys))).otherwise(bucket)
    return stats.select(level.alias("level"), bucket.alias("bucket"), F.col("n").alias("cnt"), *measures)


def attach_statistics(
    df: DataFrame,
    stats: DataFrame,
    key_sets: Sequence[KeySet],
    own: Sequence[str] = (),
    hide: Sequence[str] = (),
) -> DataFrame:
    """Join the statistics of every key set to ``df``.

    The statistics are written once and read back by every join. Unless the key domains prove that
    all sets are small, the groups are counted first: small sets are broadcast, others go through
    the sliced shuffle join.

    Training rows get the mean of the measures in ``own`` without their own value, which is the
    column of that name: (sum - value) / (n - 1). Columns in ``hide`` may be keys or own values but
    are not passed on.
    """
    stored = materialise(stats, "group-stats")
    # Every join copies the row it extends. Packed into one struct, a wide row is a single value to
    # copy, and what each lookup adds is another; they are unpacked once at the end.
    shown = [c for c in df.columns if c not in hide]
    needed = dict.fromkeys([*(["id", "split"] if own else ["id"]), *(k for s in key_sets for k in s.keys), *own])
    packed = df.select(F.struct(*shown).alias("_row"), *needed)
    unpacked, lookups = [], []
    for number, s in enumerate(key_sets):
        features = []
        for statistic, name in s.attach.items():
            found = F.col(f"_found{number}.{name}")
            if statistic in own:
                features += [F.col(f"{statistic}_sum").alias(f"{name}_sum"), F.col(f"{statistic}_n").alias(f"{name}_n")]
                total, n = F.col(f"_found{number}.{name}_sum"), F.col(f"_found{number}.{name}_n")
                found = _without_own(total, n, F.when(F.col("split") == schema.TRAIN, F.col(statistic)))
            else:
                features.append(F.col(statistic).alias(name))
            unpacked.append(found.alias(name))
        found_here = stored.where(F.col("key_set") == number)
        lookups.append(found_here.select(*s.keys, F.struct(*features).alias(f"_found{number}")))
    proven = all(fits_broadcast(lookup, s.max_groups) for lookup, s in zip(lookups, key_sets))
    measured = {} if proven else {r["key_set"]: r["count"] for r in stored.groupBy("key_set").count().collect()}
    for number, (s, lookup) in enumerate(zip(key_sets, lookups)):
        rows = s.max_groups if proven else measured.get(number, 0)
        counts = None
        if not fits_broadcast(lookup, rows):  # count the keys on the frame that came in, not on the joins so far
            counts = df.groupBy(*s.keys).agg(F.count(F.lit(1)).alias("_rows"))
        packed = attach(packed, lookup, s.keys, rows=rows, key_counts=counts)
    return packed.select("_row.*", *unpacked)


def _without_own(total: Column, n: Column, own: Column) -> Column:
    """Mean of a group without the row's own value, if the row is one that was counted."""
    return ratio(total - F.coalesce(own, F.lit(0.0)), n - own.isNotNull().cast("int"))


# --- the feature sets -----------------------------------------------------------------------------

# Sines of times mirrored in the week differ in their last bits; rounding makes them one group.
WEEK_SINE_KEY, HOUR_SINE_KEY = "_week_sine_key", "_hour_sine_key"
SINE_DIGITS = 12
# Number of values each calendar key can take.
DOMAIN = {
    "pickup_weekofyear": 53,
    "pickup_hour": 24,
    "pickup_weekday": 7,
    "pickup_week_hour": 168,
    WEEK_SINE_KEY: 10_080,
    HOUR_SINE_KEY: 24,
    "pickup_day": 31,
}


def single_key_sets(
    pickup_cluster: str, dropoff_cluster: str, clusters: int | None, suffix: str = ""
) -> list[KeySet]:
    """Nine single keys, three target means each. ``clusters`` bounds the cluster ids if known."""
    shown = {WEEK_SINE_KEY: "pickup_week_delta_sin", HOUR_SINE_KEY: "pickup_hour_sin"}
    sets = []
    for key in (*DOMAIN, pickup_cluster, dropoff_cluster):
        names = {t: schema.mean_name(t, shown.get(key, key), suffix) for t in TARGETS}
        sets.append(KeySet((key,), names, max_groups=DOMAIN.get(key, clusters)))
    return sets


def multi_key_sets(
    pickup_cluster: str,
    dropoff_cluster: str,
    clusters: int | None,
    min_count: int = 100,
    prefix: str = "lat_long_",
    bins: tuple[str, str] = ("pickup_latitude_bin", "pickup_longitude_bin"),
    suffix: str = "",
) -> list[KeySet]:
    """Eight key combinations with mean speeds and count, groups above ``min_count`` only."""
    combinations = (
        bins,
        ("pickup_week_hour", *bins),
        ("pickup_hour", *bins),
        (pickup_cluster, dropoff_cluster),
        ("pickup_week_hour", pickup_cluster, dropoff_cluster),
        ("pickup_hour", pickup_cluster, dropoff_cluster),
        ("pickup_hour", pickup_cluster),
        ("pickup_hour", dropoff_cluster),
    )
    sets = []
    for keys in combinations:
        names = {
            f"{prefix}avg_speed_h": schema.multi_name(f"{prefix}avg_speed_h", keys, suffix),
            "n": schema.multi_name("cnt", keys, suffix),
            f"{prefix}avg_speed_m": schema.multi_name(f"{prefix}avg_speed_m", keys, suffix),
        }
        bound = 1
        for key in keys:
            size = DOMAIN.get(key, clusters if "cluster" in key else None)
            bound = None if bound is None or size is None else bound * size
        sets.append(KeySet(keys, names, min_count, bound))
    return sets


def with_sine_keys(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            WEEK_SINE_KEY: round_half_even(F.col("pickup_week_delta_sin"), SINE_DIGITS),
            HOUR_SINE_KEY: round_half_even(F.col("pickup_hour_sin"), SINE_DIGITS),
        }
    )


# Hour and weekday follow from the hour of the week, so they add no groups to a list that holds it.
WEEK_HOUR_KEYS = ("pickup_week_hour", "pickup_hour", "pickup_weekday")


def _families(key_sets: Sequence[KeySet]) -> list[tuple[str, ...]]:
    """For each largest set with the hour of the week, the list its smaller sets can be derived from."""
    whole = [s.keys for s in key_sets if "pickup_week_hour" in s.keys and len(s.keys) > 1]
    return [(*WEEK_HOUR_KEYS, *(k for k in keys if k not in WEEK_HOUR_KEYS)) for keys in whole]


def with_group_features(
    df: DataFrame,
    key_sets: Sequence[KeySet],
    targets: Sequence[str] = TARGETS,
    leave_one_out: bool = False,
    keep_targets: bool = True,
    source: DataFrame | None = None,
) -> DataFrame:
    """Means over training rows, taken from ``source`` if given, attached to all rows. ``df`` holds the target columns."""
    keyed = with_sine_keys(df)
    measures = {t: F.col(t) for t in targets}
    train = (with_sine_keys(source) if source else keyed).where(F.col("split") == schema.TRAIN)
    stats = grouped(train, key_sets, measures, sums=leave_one_out, through=_families(key_sets))
    hide = (WEEK_SINE_KEY, HOUR_SINE_KEY, *(() if keep_targets else targets))
    return attach_statistics(keyed, stats, key_sets, targets if leave_one_out else (), hide)


STREETS = ("starting_street", "end_street")
STREET_SETS = (
    KeySet(("starting_street",), {"trip_duration": "starting_street_heavy"}),
    KeySet(("end_street",), {"trip_duration": "end_street_heavy"}),
)


def with_street_encoding(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Mean training duration per starting and per end street, taken from ``source`` if given."""
    measures = {"trip_duration": F.col("trip_duration")}
    stats = grouped((source or df).where(F.col("split") == schema.TRAIN), STREET_SETS, measures)
    return attach_statistics(df, stats, STREET_SETS)


VENDOR_WEEKDAY = KeySet(("vendor_id", "pickup_weekday"), {"trip_duration": "groupby_vi_pweekdat_trip_duration"})


def with_vendor_weekday_mean(df: DataFrame) -> DataFrame:
    """Mean training duration of the row's vendor and weekday, for every row."""
    measures = {"trip_duration": F.col("trip_duration")}
    stats = grouped(df.where(F.col("split") == schema.TRAIN), [VENDOR_WEEKDAY], measures)
    return attach_statistics(df, stats, [VENDOR_WEEKDAY])
