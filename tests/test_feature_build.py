"""The whole feature build: stages, optional steps and plan shape."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tripworks.operators import cluster, features
from tripworks.plans import feature_build, queries
from tripworks.sources import fixtures
from tripworks.sources.stages import FeatureCache, StageStore


@pytest.fixture(scope="module")
def inputs(spark):
    return fixtures.trips(spark, SMALL), fixtures.routes(spark, SMALL), fixtures.weather(spark, SMALL)


def test_stages_are_stored_and_resumed(spark, folder, inputs):
    cfg = feature_build.Config(clusters=8, cluster_iterations=3, min_count=10)
    store = StageStore(spark, folder)
    built = feature_build.build_features(*inputs, cfg, store)
    assert store.under(cfg.digest()).latest() == feature_build.LAST_STAGE == 7
    assert built.count() == inputs[0].count()
    for name in ("pickup_kmeans_8_cluster", "cnt_pickup_hour_pickup_kmeans_8_cluster", "snow_fall", "is_holyday", "pca_direction"):
        assert name in built.columns
    for name in ("starting_street", "store_and_fwd_flag", "lat_long_avg_speed_h", "log_trip_duration"):
        assert name not in built.columns
    again = feature_build.build_features(None, None, None, cfg, store)
    assert sorted(again.columns) == sorted(built.columns)
    assert "pickup_datetime" not in feature_build.model_input(built).columns
    other = feature_build.Config(clusters=8, cluster_iterations=3, min_count=11)
    assert other.digest() != cfg.digest() and store.under(other.digest()).latest() is None


def _differences(one, two):
    """Ids and columns in which two frames differ by more than the order of sums can explain."""
    columns = sorted(one.columns)
    assert columns == sorted(two.columns)
    left, right = ({r["id"]: r for r in df.collect()} for df in (one, two))
    assert left.keys() == right.keys()

    def same(a, b):
        return a == b or (isinstance(a, float) and isinstance(b, float) and a == pytest.approx(b, rel=1e-6, abs=1e-9))

    return [(i, c, left[i][c], right[i][c]) for i in left for c in columns if not same(left[i][c], right[i][c])]


@pytest.mark.parametrize("stopped_after", [3, 5])
def test_a_build_that_goes_on_equals_one_in_a_single_run(spark, folder, inputs, monkeypatch, stopped_after):
    cfg = feature_build.Config(clusters=12, cluster_iterations=2, min_count=10, heavy_quantile=0.8, window_minutes=(10,))
    fit, models = cluster.fit_location_clusters, []

    def once(*args):  # k-means starts from rows as they lie in partitions, so two fits may differ
        models[:] = models or [fit(*args)]
        return models[0]

    monkeypatch.setattr(cluster, "fit_location_clusters", once)
    whole = feature_build.build_features(*inputs, cfg)
    store, save = StageStore(spark, folder), StageStore.save

    def broken(self, stage, df, notes=None):
        if stage > stopped_after:
            raise KeyboardInterrupt
        save(self, stage, df, notes)

    monkeypatch.setattr(StageStore, "save", broken)
    with pytest.raises(KeyboardInterrupt):
        feature_build.build_features(*inputs, cfg, store)
    monkeypatch.setattr(StageStore, "save", save)
    assert store.under(cfg.digest()).latest() == stopped_after
    assert _differences(feature_build.build_features(*inputs, cfg, store), whole)[:5] == []


def test_stages_of_other_trips_are_not_read(spark, folder, inputs):
    cfg = queries._grid_config(min_count=10)
    store = StageStore(spark, folder)
    trips, routes, weather = inputs
    feature_build.build_features(trips, routes, weather, cfg, store)
    fewer = feature_build.build_features(trips.where("id > 'id0001000'"), routes, weather, cfg, store)
    assert fewer.count() == trips.where("id > 'id0001000'").count()


def other_place(df):
    return df


def test_only_named_functions_make_a_key():
    named = [feature_build.Config(locate=f).digest() for f in (queries._celled, other_place)]
    assert len(set(named)) == 2 and named[0] == feature_build.Config(locate=queries._celled).digest()
    for unnamed in (lambda df: df, (lambda step: lambda df: df.limit(step))(3)):
        with pytest.raises(ValueError):
            feature_build.Config(locate=unnamed).digest()


def test_optional_steps(inputs):
    cfg = queries._grid_config(heavy_quantile=0.8, max_distance=12.0, max_missing_rate=0.25, leave_one_out=True)
    cfg = feature_build.Config(**{**cfg.__dict__, "clusters": 6})
    df = feature_build.build_features(*inputs, cfg)
    assert any("heavy_traffic_cluster" in c for c in df.columns)
    assert "dropoff_datetime" not in df.columns and "trip_duration" in df.columns
    assert df.count() < inputs[0].count()


def test_feature_plans_hold_no_python(spark, inputs):
    trips = inputs[0]
    df = features.with_holidays(
        features.with_great_circle_miles(feature_build.clean(feature_build.basic_features(trips.withColumn("is_store_and_fwd_flag", F.lit(0)), feature_build.Config()), feature_build.Config()))
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_what_a_query_needs(spark):
    plan = queries.REGISTRY["numeric_id"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_train_means_do_not_see_test_rows(spark, inputs):
    from tripworks.operators import stats

    trips = inputs[0]
    louder = trips.withColumn("trip_duration", F.when(F.col("split") == "test", 10**6).otherwise(F.col("trip_duration")))
    means = []
    for df in (trips, louder):
        out = stats.with_vendor_weekday_mean(features.with_calendar(df))
        means.append(sorted(tuple(r) for r in out.select("id", "groupby_vi_pweekdat_trip_duration").collect()))
    assert means[0] == means[1]


def test_grid_cells_are_numbered_by_row_and_column(spark):
    df = spark.createDataFrame(
        [(40.64, -74.02, 40.69, -73.9)],
        "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double",
    )
    r = cluster.with_grid_clusters(df, 40.63, -74.03).first()
    assert (r["pickup_cell"], r["dropoff_cell"]) == (0, 102)


def test_fewer_points_than_clusters_and_one_fit(spark, inputs, monkeypatch, folder):
    fits = []
    fit = cluster.fit_location_clusters
    monkeypatch.setattr(cluster, "fit_location_clusters", lambda *a, **k: fits.append(1) or fit(*a, **k))
    trips = inputs[0].orderBy("id").limit(8)
    cache = FeatureCache(spark, folder)
    cfg = feature_build.Config(clusters=100, cluster_iterations=3, min_count=0, heavy_quantile=0.5, window_minutes=(10,), cache=cache)
    df = feature_build.build_features(trips, *inputs[1:], cfg)
    assert df.count() == 8 and len(fits) == 1
    assert {"pickup_kmeans_100_cluster", "this_pickup_kmeans_100_clusterafter_10minutes_traffic"} <= set(df.columns)
    again = feature_build.build_features(trips, *inputs[1:], cfg)
    assert sorted(map(str, again.select("id", *sorted(c for c in df.columns if "traffic" in c)).collect())) == sorted(
        map(str, df.select("id", *sorted(c for c in df.columns if "traffic" in c)).collect())
    )


def test_wide_rows_are_shuffled_by_id_once(spark, inputs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = feature_build.build_features(*inputs, queries._grid_config(window_minutes=(10,)))
        plan = df._jdf.queryExecution().executedPlan()
        lines = [x for x in plan.toString().splitlines() if "Exchange hashpartitioning(id#" in x]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(lines) <= 3  # the wide frame, the traffic counts, the routes


def _exchanges(node):
    if node.nodeName() == "AdaptiveSparkPlan":
        node = node.initialPlan()
    if node.nodeName() == "Exchange":
        yield node
    for i in range(node.children().size()):
        yield from _exchanges(node.children().apply(i))


@pytest.mark.parametrize("minutes", [(), (10, 15)])
def test_trips_are_shuffled_before_they_are_wide(spark, inputs, minutes):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = feature_build.build_features(*inputs, queries._grid_config(window_minutes=minutes))
        found = list(_exchanges(df._jdf.queryExecution().executedPlan()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_id = [x.output().size() for x in found if "hashpartitioning(id#" in x.outputPartitioning().toString()]
    assert by_id and max(by_id) <= 20 < len(df.columns) - 60


def test_repeated_and_missing_ids_meet_the_same_rows(spark, folder, inputs):
    """Joining by id before the group statistics gives what joining after them gave, as a build in stages does."""
    trips, routes, weather = inputs
    few = trips.where("id < 'id0000200'")
    odd = few.unionByName(few.where("id < 'id0000020'")).withColumn("id", F.when(F.col("id") != "id0000030", F.col("id")))
    cfg = queries._grid_config(min_count=2, window_minutes=(10,))
    shown = ["id", "cnt_pickup_hour_pickup_cell", "total_distance", "starting_street_heavy", "this_pickup_cellafter_10minutes_traffic"]
    built = [feature_build.build_features(odd, routes, weather, cfg, store) for store in (None, StageStore(spark, folder))]
    rows = [sorted(map(str, df.select(*shown).collect())) for df in built]
    assert rows[0] == rows[1] and len(rows[0]) > odd.count()
