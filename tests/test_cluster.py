"""Clusters and distances to the busy ones, checked against brute force."""

import math

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tripworks.operators import cluster, nearest
from tripworks.sources import fixtures


@pytest.fixture(scope="module")
def trips(spark):
    return fixtures.trips(spark, SMALL).select(
        "id", "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"
    ).cache()


@pytest.fixture(scope="module")
def model(trips):
    return cluster.fit_location_clusters(trips, k=12, seed=3, max_iter=5)


def test_points_are_merged_with_their_weight(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 1.0, 2.0), (1.0, 2.0, 5.0, 6.0), (None, 2.0, 5.0, 6.0)],
        "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double",
    )
    found = {(r["lat"], r["lng"]): r["weight"] for r in cluster.stacked_points(df).collect()}
    assert found == {(1.0, 2.0): 3.0, (5.0, 6.0): 2.0}


def test_each_end_goes_to_its_nearest_centre(trips, model):
    centres = np.array(model.clusterCenters())
    assert len(centres) <= 12
    assigned = cluster.assign_clusters(trips, model)
    assert assigned.columns[-2:] == [f"{e}_kmeans_{len(centres)}_cluster" for e in ("pickup", "dropoff")]
    for r in assigned.collect():
        for end, found in (("pickup", r[-2]), ("dropoff", r[-1])):
            point = np.array([r[f"{end}_latitude"], r[f"{end}_longitude"]])
            distances = ((centres - point) ** 2).sum(axis=1)
            assert distances[found] == pytest.approx(distances.min(), abs=1e-9)


def test_missing_coordinates_have_no_cluster(spark, model):
    df = spark.createDataFrame(
        [("a", None, -74.0, 40.7, -74.0)],
        "id string, pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double",
    )
    r = cluster.assign_clusters(df, model, "p", "d").first()
    assert r["p"] is None and r["d"] is not None


def test_traffic_counts_clusters_seen_at_one_end(spark):
    df = spark.createDataFrame([(1, 2), (1, 1), (3, None)], "p int, d int")
    assert {r["cluster"]: r["traffic"] for r in cluster.cluster_traffic(df, "p", "d").collect()} == {1: 3, 2: 1, 3: 1}


def test_heavy_clusters_lie_above_the_quantile(spark):
    traffic = spark.createDataFrame([(i, i * 10) for i in range(10)], "cluster int, traffic long")
    limit = np.percentile([i * 10 for i in range(10)], 80)
    heavy = [r["cluster"] for r in cluster.heavy_clusters(traffic, 0.8).collect()]
    assert heavy == [i for i in range(9, -1, -1) if i * 10 > limit]


def test_distances_to_heavy_centres(trips):
    centres = {4: (40.7, -74.0)}
    out = cluster.with_heavy_cluster_distances(trips, centres, [4])
    assert out.columns[-4:] == [
        f"{e}_heavy_traffic_cluster4_{kind}" for e in ("pickup", "dropoff") for kind in ("haversine", "bearing")
    ]
    for r in out.orderBy("id").limit(20).collect():
        a, b = math.radians(r["dropoff_latitude"]), math.radians(40.7)
        turn = math.radians(-74.0 - r["dropoff_longitude"])
        h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(turn / 2) ** 2
        assert r["dropoff_heavy_traffic_cluster4_haversine"] == pytest.approx(2 * 6371 * math.asin(math.sqrt(h)))
        bearing = math.degrees(
            math.atan2(math.sin(turn) * math.cos(b), math.cos(a) * math.sin(b) - math.sin(a) * math.cos(b) * math.cos(turn))
        )
        assert r["dropoff_heavy_traffic_cluster4_bearing"] == pytest.approx(bearing)


def test_heavy_features_add_no_join(trips):
    model = cluster.fit_location_clusters(trips, k=10, seed=1)
    located = cluster.assign_clusters(trips, model, "p", "d")
    out = cluster.heavy_cluster_features(located, "p", "d", 0.8, model.clusterCenters())
    means = cluster.heavy_cluster_features(located, "p", "d", 0.8)
    assert means.columns == out.columns
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and len(out.columns) == 1 + 4 * 2


def test_equally_near_centres_and_missing_points(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 5.0, 5.0), (None, 0.0, 1.0, 1.0)],
        "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double",
    )
    out = cluster.assign_to_centres(df, [(1.0, 0.0), (0.0, 1.0), (5.0, 5.0)], "p", "d").collect()
    assert [(r["p"], r["d"]) for r in out] == [(0, 2), (None, 0)]


@pytest.mark.parametrize("k,digits", [(1, 6), (2, 6), (30, 1), (100, 6), (400, 3)])
def test_the_grid_finds_the_nearest_of_all_centres(spark, k, digits):
    rng = np.random.default_rng(k)
    centres = np.round(rng.normal([40.7, -73.95], [0.1, 0.05], (k, 2)), digits)
    near, far = rng.normal([40.7, -73.95], [0.15, 0.1], (4000, 2)), rng.normal(0, 300, (200, 2))
    points = np.concatenate([near, np.round(near[:500], 1), centres, far, rng.normal(0, 1e7, (50, 2))])
    df = spark.createDataFrame([(i, float(y), float(x)) for i, (y, x) in enumerate(points)] + [(-1, None, 1.0)], "i int, y double, x double")
    index = nearest.CentreIndex(centres)
    found = {r["i"]: r["c"] for r in index.assign(df, {"c": (F.col("y"), F.col("x"))}).collect()}
    assert found.pop(-1) is None
    for i, (y, x) in enumerate(points):
        assert found[i] == int(np.argmin((y - centres[:, 0]) * (y - centres[:, 0]) + (x - centres[:, 1]) * (x - centres[:, 1])))


def test_work_per_row_does_not_grow_with_the_centres():
    rng = np.random.default_rng(4)
    few, many = (nearest.CentreIndex(rng.uniform(0, 1, (k, 2))) for k in (100, 800))
    assert few.most <= 10 and many.most <= 10 and many.mean_candidates() < 1.3 * few.mean_candidates()


def test_small_batches_come_near_the_full_fit(spark, trips):
    full = cluster.fit_location_clusters(trips, k=25, seed=3, max_iter=20).clusterCenters()
    small = cluster.fit_mini_batch_clusters(trips, k=25, seed=3, batch=1000, batches=20)
    assert len(small) == 25
    costs = [cluster.clustering_cost(trips, c).first()["cost"] for c in (full, small)]
    assert costs[1] <= 1.1 * costs[0]
    points = np.array([(r[f"{e}_latitude"], r[f"{e}_longitude"]) for r in trips.collect() for e in cluster.ENDS])
    brute = ((points[:, None, :] - np.array(small)[None]) ** 2).sum(axis=2).min(axis=1).sum()
    assert costs[1] == pytest.approx(brute)


def test_a_batch_reads_its_own_folder(spark, trips):
    from tripworks.sources.scratch import materialise_parts

    points = cluster.stacked_points(trips).withColumn("part", F.pmod(F.xxhash64("lat", "lng"), F.lit(5)).cast("int"))
    dealt = materialise_parts(points, "part", "test-parts")
    plan = dealt.where("part = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    sizes = [dealt.where(F.col("part") == k).count() for k in range(5)]
    assert sum(sizes) == points.count() and max(sizes) < 0.3 * sum(sizes)


def test_few_or_no_points(spark):
    ends = "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double"
    assert cluster.fit_mini_batch_clusters(spark.createDataFrame([], ends), k=3) == []
    two = spark.createDataFrame([(1.0, 2.0, 1.0, 2.0), (3.0, 4.0, None, 4.0)], ends)
    assert sorted(cluster.fit_mini_batch_clusters(two, k=5)) == [(1.0, 2.0), (3.0, 4.0)]
