"""Group statistics, joins back and skew handling."""

import pytest
from pyspark.sql import functions as F

from tripworks.operators import joins, stats
from tripworks.operators.stats import KeySet

SCHEMA = "id string, split string, k string, j int, y double"
ROWS = [
    ("a", "train", "x", 1, 2.0),
    ("b", "train", "x", 2, 4.0),
    ("c", "train", "y", 1, 10.0),
    ("d", "train", None, 1, 99.0),
    ("e", "train", "x", 1, None),
    ("f", "test", "x", 1, None),
    ("g", "test", "z", 1, None),
    ("h", "test", None, 2, None),
]


def features(df, sets, **settings):
    measured = stats.grouped(df.where("split = 'train'"), sets, {"y": F.col("y")}, sums="own" in settings)
    return {r["id"]: r for r in stats.attach_statistics(df, measured, sets, **settings).collect()}


@pytest.mark.parametrize("broadcast_bytes", [joins.BROADCAST_BYTES, -1])
def test_means_come_from_train_and_reach_test(spark, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", broadcast_bytes)
    df = spark.createDataFrame(ROWS, SCHEMA)
    sets = [KeySet(("k",), {"y": "mean"}), KeySet(("k", "j"), {"y": "pair", "n": "cnt"})]
    found = features(df, sets)
    assert len(found) == len(ROWS)
    assert {i: r["mean"] for i, r in found.items()} == {
        "a": 3.0, "b": 3.0, "c": 10.0, "d": None, "e": 3.0, "f": 3.0, "g": None, "h": None,
    }
    assert found["f"]["pair"] == 2.0 and found["f"]["cnt"] == 2 and found["b"]["cnt"] == 1


def test_groups_at_or_below_min_count_are_left_out(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    found = features(df, [KeySet(("k",), {"y": "mean"}, min_count=2)])
    assert found["a"]["mean"] == 3.0 and found["c"]["mean"] is None


def test_leave_one_out(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    found = features(df, [KeySet(("k",), {"y": "mean"})], own=["y"])
    assert (found["a"]["mean"], found["b"]["mean"]) == (4.0, 2.0)
    assert found["c"]["mean"] is None  # alone in its group
    assert found["e"]["mean"] == 3.0 and found["f"]["mean"] == 3.0  # nothing of their own was counted


def test_test_rows_do_not_change_the_statistics(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    louder = df.withColumn("y", F.when(F.col("split") == "test", 1e9).otherwise(F.col("y")))
    sets = [KeySet(("k",), {"y": "mean"})]
    assert {i: r["mean"] for i, r in features(df, sets).items()} == {i: r["mean"] for i, r in features(louder, sets).items()}


def test_sliced_join_equals_plain_join(spark):
    """A third of the rows under one key, a third without a key, the rest spread out."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") + 100)
    df = spark.range(30_000).select(F.col("id").cast("string").alias("id"), key.cast("long").alias("k"))
    lookup = df.where("k is not null and k % 11 != 0").select("k", (F.col("k") * 2).alias("v")).distinct()
    sliced = joins.attach(df, lookup, ["k"], slice_rows=1_000)
    plain = df.join(lookup, "k", "left").select("id", "k", "v")
    assert sorted(map(tuple, sliced.select("id", "k", "v").collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_heavy_key_is_spread_over_slices(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("k"))
    joined = joins.attach(df, df.select("k", F.lit(5).alias("v")).distinct(), ["k"], slice_rows=100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        largest = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert joined.where("v = 5").count() == 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert largest < 20_000 / 3  # four shuffle partitions, one key


def test_proven_small_sets_are_broadcast_and_scanned_once(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    sets = [KeySet(("k",), {"y": "m1"}, max_groups=10), KeySet(("j",), {"y": "m2"}, max_groups=10)]
    measured = stats.grouped(df.where("split = 'train'"), sets, {"y": F.col("y")})
    plan = stats.attach_statistics(df, measured, sets)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert measured._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_names_of_the_feature_sets():
    single = stats.single_key_sets("pickup_kmeans_100_cluster", "dropoff_kmeans_100_cluster", 100)
    multi = stats.multi_key_sets("pickup_kmeans_100_cluster", "dropoff_kmeans_100_cluster", 100)
    assert len([n for s in single for n in s.attach.values()]) == 27
    assert len([n for s in multi for n in s.attach.values()]) == 24
    assert single[4].attach["log_trip_duration"] == "log_trip_duration_gby_pickup_week_delta_sin"
    assert multi[0].attach["n"] == "cnt_pickup_latitude_bin_pickup_longitude_bin"
    assert [s.max_groups for s in multi] == [None, None, None, 10_000, 1_680_000, 240_000, 2_400, 2_400]
    suffixed = stats.single_key_sets("p", "d", 36, suffix="_n_clusters_36")
    assert suffixed[1].attach["log_trip_duration"] == "log_trip_duration_gby_pickup_hour_n_clusters_36"


def test_key_below_a_thousandth_is_cut_when_it_exceeds_the_target(spark):
    # one key of 300 rows among 400,000: no share to speak of, but three times the target
    key = F.when(F.col("id") < 300, F.lit(-1)).otherwise(F.col("id"))
    df = spark.range(400_000).select(F.col("id").cast("string").alias("id"), key.alias("k"))
    counts = df.groupBy("k").agg(F.count(F.lit(1)).alias("_rows"))
    lookup = df.where("k < 1000").select("k", F.lit(1).alias("v")).distinct()
    joined = joins.attach(df, lookup, ["k"], key_counts=counts, slice_rows=100)
    assert joined.where("k = -1 and v = 1").count() == 300 and joined.count() == 400_000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan


def test_sets_derived_from_a_finer_one_are_the_same(spark):
    df = spark.range(5_000).select(
        (F.col("id") % 24).alias("h"), (F.col("id") % 7).alias("b"), F.when(F.col("id") % 11 > 0, F.col("id") % 5).alias("c"),
        F.when(F.col("id") % 13 > 0, F.col("id").cast("double")).alias("y"),
    )
    sets = [KeySet(k, {}) for k in (("h",), ("b",), ("h", "b"), ("c",), ("h", "c"))]
    direct = stats.grouped(df, sets, {"y": F.col("y")}, sums=True)
    derived = stats.grouped(df, sets, {"y": F.col("y")}, sums=True, through=[("h", "b"), ("h", "c")])
    assert direct.columns == derived.columns
    assert sorted(map(str, direct.collect())) == sorted(map(str, derived.collect()))
