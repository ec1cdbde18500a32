"""Window counts against a naive self-join on small rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tripworks.functions.calendar import MICROS_PER_MINUTE
from tripworks.operators import traffic
from tripworks.operators.traffic import Span

SCHEMA = "id string, c int, s long"


def moments(seed, n=400, unit=1_000_000):
    """Ties, hot moments, missing times and missing clusters."""
    random.seed(seed)
    rows = []
    for i in range(n):
        cluster = random.choice([0, 0, 0, 1, 2, None])
        time = random.choice([random.randrange(0, 7200), 3600, None]) if i % 3 else 3600
        rows.append((str(i), cluster, None if time is None else time * unit + (i % 7 if unit > 1 else 0)))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("ts", F.timestamp_micros("s").cast("timestamp_ntz"))


def naive(rows, span, keyed=True):
    counts = {}
    for i, c, s in rows:
        near = [
            1
            for _, d, t in rows
            if s is not None and t is not None and span.first <= t - s <= span.last
            and (not keyed or (c is not None and c == d))
        ]
        counts[i] = len(near)
    return counts


ODD = [Span(1, 1_500_000), Span(-2_500_001, -3), Span(999_999, 3_000_001), Span(0, 0), Span(-700, 0)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("span", [Span.after(10), Span.before(10), Span.trailing(60), *ODD])
def test_counts_equal_a_naive_self_join(spark, seed, span):
    rows = moments(seed)
    got = traffic.with_window_counts(frame(spark, rows), "ts", ["c"], {"n": span}).collect()
    assert {r["id"]: r["n"] for r in got} == naive(rows, span)
    got = traffic.with_window_counts(frame(spark, rows), "ts", [], {"n": span}).collect()
    assert {r["id"]: r["n"] for r in got} == naive(rows, span, keyed=False)


@pytest.mark.parametrize("unit", [250_000, 400, 1])
def test_sub_second_moments_and_edges(spark, unit):
    rows = moments(5, 300, unit)
    spans = {f"n{i}": s for i, s in enumerate([*ODD, Span(3, 5), Span(-1_000_000, -1)])}
    got = traffic.with_window_counts(frame(spark, rows), "ts", ["c"], spans).collect()
    for name, span in spans.items():
        assert {r["id"]: r[name] for r in got} == naive(rows, span)


def test_both_ends_of_the_window_are_open(spark):
    minute = MICROS_PER_MINUTE
    rows = [("t", 0, 0), ("near", 0, 1), ("in", 0, 10 * minute - 1), ("out", 0, 10 * minute), ("same", 0, 0)]
    spans = {"after": Span.after(10), "before": Span.before(10), "trail": Span.trailing(10)}
    got = {r["id"]: r for r in traffic.with_window_counts(frame(spark, rows), "ts", ["c"], spans).collect()}
    assert (got["t"]["after"], got["t"]["before"], got["t"]["trail"]) == (2, 0, 2)
    assert (got["out"]["after"], got["out"]["before"], got["out"]["trail"]) == (0, 2, 3)


def test_partitioning_does_not_matter(spark):
    df = frame(spark, moments(3))
    spans = {"n": Span.after(15)}
    one = traffic.with_window_counts(df.coalesce(1), "ts", ["c"], spans)
    many = traffic.with_window_counts(df.repartition(7), "ts", ["c"], spans)
    assert sorted((r["id"], r["n"]) for r in one.collect()) == sorted((r["id"], r["n"]) for r in many.collect())


def test_windows_are_partitioned_by_time(spark):
    plan = traffic.with_window_counts(frame(spark, moments(1)), "ts", [], {"n": Span.trailing(60)})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_bucket" in text and "windowspecdefinition(_cell" in text


def test_names_and_direction(spark):
    df = frame(spark, moments(4)).withColumnsRenamed({"c": "pickup_kmeans_100_cluster", "ts": "pickup_datetime"})
    out = traffic.with_pickup_traffic(df)
    assert out.columns[-2:] == [f"this_pickup_kmeans_100_clusterafter_{m}minutes_traffic" for m in (10, 15)]
    with pytest.raises(ValueError):
        traffic.with_window_counts(df, "pickup_datetime", [], {"n": Span(-1, 1)})


def test_no_frame_is_added_up_anew_for_each_cell(spark):
    plan = traffic.with_window_counts(frame(spark, moments(1)), "ts", ["c"], {"a": Span.after(10), "t": Span.trailing(60)})
    frames = re.findall(r"specifiedwindowframe\((\w+), (\w+)", plan._jdf.queryExecution().optimizedPlan().toString())
    assert frames and all("unboundedpreceding" in start for _, start in frames)
