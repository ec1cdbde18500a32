"""Profiling, percentiles and imputation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripworks.operators import profile, rows


def test_missing_profile_lists_only_columns_with_gaps(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b")], "x int, y int, z string")
    found = [tuple(r) for r in profile.missing_profile(df).collect()]
    assert found == [("y", 2, 1.0), ("x", 1, 0.5)]


def test_drop_sparse_columns_is_strict(spark):
    df = spark.createDataFrame([(1, None, 1), (2, None, None)], "x int, y int, z int")
    assert profile.drop_sparse_columns(df, 1.0).columns == ["x", "y", "z"]
    assert profile.drop_sparse_columns(df, 0.5).columns == ["x", "z"]


def test_drift_uses_rounded_columns(spark):
    data = [("train", 1.0), ("train", 3.0), ("train", None), ("test", 2.00004), ("test", 6.0)]
    df = spark.createDataFrame(data, "split string, x double")
    r = profile.drift_profile(df, ["x"]).first()
    assert (r["train_mean"], r["test_mean"], r["train_std"], r["test_std"]) == (2.0, 4.0, 1.0, 2.0)
    assert (r["train_nan"], r["test_nan"]) == (0.333, 0.0)
    assert r["train_test_mean_diff"] == pytest.approx(2.0 / 3.0 * 2)
    reports = profile.check_before_modelling(df, ["x"])
    assert reports["train_missing"].count() == 1 and reports["mean_drift"].count() == 1


def columns_of_values():
    random.seed(5)
    spread = [random.gauss(0, 1) for _ in range(3000)]
    heavy = [7.0] * 1500 + [random.random() * 20 for _ in range(1500)]
    two_heavy = [0.0] * 1000 + [1.0] * 1000 + [random.random() for _ in range(500)]
    return {"spread": spread, "heavy": heavy, "two_heavy": two_heavy, "single": [3.5], "constant": [2.0] * 50}


@pytest.mark.parametrize("name", list(columns_of_values()))
def test_narrowing_finds_exact_percentiles(spark, monkeypatch, name):
    values = columns_of_values()[name]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    expected = np.percentile(values, [0, 25, 50, 99, 100])
    shares = [0.0, 0.25, 0.5, 0.99, 1.0]
    assert profile.exact_percentiles(df, ["x"], shares)["x"] == pytest.approx(list(expected))
    # A bracket this wide and a limit this small force several rounds.
    monkeypatch.setattr(profile, "_SKETCH_ACCURACY", 20)
    assert profile.exact_percentiles(df, ["x"], shares, few=10)["x"] == pytest.approx(list(expected))


def test_passes_do_not_depend_on_the_number_of_ranks(spark):
    df = spark.range(50_000).select(F.col("id").alias("x"), (F.col("id") * 7 % 50_000).alias("y"))
    tracker = spark.sparkContext.statusTracker()

    def jobs(columns, shares):
        spark.sparkContext.setJobGroup(name := f"{columns}{shares}", "")
        found = profile.exact_percentiles(df, columns, shares)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found, len(tracker.getJobIdsForGroup(name))

    one, few_jobs = jobs(["x"], [0.5])
    all_, more_jobs = jobs(["x", "y"], [0.1, 0.25, 0.5, 0.75, 0.9])
    assert one["x"] == [24_999.5] and all_["y"] == all_["x"] == pytest.approx([s * 49_999 for s in (0.1, 0.25, 0.5, 0.75, 0.9)])
    assert more_jobs <= few_jobs + 2


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert profile.exact_percentiles(df, ["x"], [0.5]) == {"x": [None]}


def test_describe(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "x int")
    found = {r["statistic"]: r["value"] for r in profile.describe(df, ["x"]).collect()}
    assert found == {
        "count": 4.0, "mean": 2.5, "std": pytest.approx(1.2909944), "min": 1.0, "25%": 1.75, "50%": 2.5, "75%": 3.25, "max": 4.0,
    }


def test_most_frequent_ignores_missing_and_breaks_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), (None,)], "x string")
    assert sorted(r["x"] for r in profile.impute_most_frequent(df, "x").collect()) == ["a", "a", "a", "a", "b"]


def test_low_cardinality_columns_are_found_exactly(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 10).alias("ten"),
        (F.col("id") % 11).alias("eleven"),
        F.col("id").alias("many"),
        F.when(F.col("id") % 2 == 0, F.lit(1.5)).alias("one_and_missing"),
        F.lit("a").alias("text"),
    )
    assert profile.low_cardinality_columns(df, 10) == ["ten", "one_and_missing"]
    for many in (256, 257, 512, 600, 20_000):
        wide = df.select(*df.columns, (F.col("many") % many).alias("exact"), (F.col("many") % (many + 1)).alias("over"))
        found = profile.low_cardinality_columns(wide, many)
        assert "exact" in found and ("over" in found) == (many >= 20_000)
    filled = profile.impute_low_cardinality(df)
    assert dict(filled.dtypes)["ten"] == "tinyint" and dict(filled.dtypes)["many"] == "bigint"
    assert {r[0] for r in filled.select("one_and_missing").distinct().collect()} == {1, -1}


def test_thresholds_range_and_histogram(spark):
    df = spark.createDataFrame([(1,), (10,), (360001,), (3599,)], "trip_duration long")
    assert tuple(profile.threshold_counts(df).first()) == (1, 2, 1)
    assert tuple(profile.duration_range(df).first()) == (100, 1)
    bins = {r["bin_from"]: r["cnt"] for r in profile.histogram(df, F.col("trip_duration"), 10).collect()}
    assert bins == {0.0: 1, 10.0: 1, 3590.0: 1, 360000.0: 1}


def test_row_operators(spark):
    train = spark.createDataFrame([("id1", "Y", 5)], "id string, store_and_fwd_flag string, trip_duration long")
    test = spark.createDataFrame([(None, "id22")], "store_and_fwd_flag string, id string")
    both = rows.encode_flag(rows.stack_splits(train, test))
    found = {r["id"]: r for r in both.collect()}
    assert found["id1"]["is_store_and_fwd_flag"] == 1 and found["id22"]["is_store_and_fwd_flag"] == 0
    assert found["id22"]["trip_duration"] is None and found["id22"]["split"] == "test"
    assert dict(rows.narrow_types(both).dtypes)["is_store_and_fwd_flag"] == "smallint"
    assert rows.filter_outliers(both).count() == 2


def test_hash_splits_do_not_depend_on_partitioning(spark):
    df = spark.range(1000).select(F.concat(F.lit("id"), F.col("id").cast("string")).alias("id"))
    for operator in (rows.holdout_split, rows.assign_folds, lambda d: rows.systematic_sample(d, 10)):
        one, many = operator(df.coalesce(1)).collect(), operator(df.repartition(9)).collect()
        assert sorted(map(tuple, one)) == sorted(map(tuple, many))
    assert rows.systematic_sample(df, 10).count() == 100
    share = rows.holdout_split(df).where("part = 'fit'").count() / 1000
    assert 0.7 < share < 0.8


def test_shuffle_is_a_repeatable_permutation(spark):
    df = spark.range(200).select(F.concat(F.lit("id"), F.col("id").cast("string")).alias("id"))
    once = [r["id"] for r in rows.shuffle_rows(df, 1).collect()]
    again = [r["id"] for r in rows.shuffle_rows(df.repartition(5), 1).collect()]
    assert once == again and once != [r["id"] for r in rows.shuffle_rows(df, 2).collect()]
    assert sorted(once) == sorted(r["id"] for r in df.collect())


def test_density_is_near_that_of_the_rows(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    values = np.concatenate([rng.normal(2, 0.5, 600), rng.normal(6, 1, 300), [50.0]])
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("a", None), ("b", 3.0)], "g string, v double")
    low, high, bins, width = 0.0, 10.0, 400, 0.3
    got = {(r["g"], round(r["point"], 6)): r["density"] for r in profile.density(df, F.col("v"), low, high, bins, width, ["g"]).collect()}
    bound = (high - low) / bins / 2 * 0.242 / width**2 + 1e-6
    for k in range(bins):
        point = low + (k + 0.5) * (high - low) / bins
        exact = np.exp(-(((point - values) / width) ** 2) / 2).sum() / (len(values) * width * np.sqrt(2 * np.pi))
        assert abs(got.get(("a", round(point, 6)), 0.0) - exact) <= bound
    assert max(p for g, p in got if g == "b") < 3.0 + 5.1 * width
    alone = profile.density(df.where("g = 'b'"), F.col("v"), low, high, bins, width).agg(F.sum("density")).first()[0]
    assert abs(alone * (high - low) / bins - 1) < 1e-3
