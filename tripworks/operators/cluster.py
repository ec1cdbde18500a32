"""Location clusters, their traffic and distances to the busy ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from tripworks.functions import geo
from tripworks.functions.numeric import array_constant
from tripworks.operators.nearest import CentreIndex
from tripworks.sources import schema
from tripworks.sources.scratch import discard, materialise, materialise_parts

ENDS = ("pickup", "dropoff")


def stacked_points(df: DataFrame) -> DataFrame:
    """Distinct pickup and dropoff points of all trips with how often they occur.

    Equal points are merged before the shuffle, so a place where a third of all trips start is one
    row, and k-means on weighted points has the same optimum as on the rows themselves.
    """
    ends = [F.struct(F.col(f"{e}_latitude").alias("lat"), F.col(f"{e}_longitude").alias("lng")) for e in ENDS]
    return (
        df.select(F.explode(F.array(*ends)).alias("point"))
        .select("point.lat", "point.lng")
        .where(F.col("lat").isNotNull() & F.col("lng").isNotNull())
        .groupBy("lat", "lng")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )


def fit_location_clusters(df: DataFrame, k: int = 100, seed: int = 1000, max_iter: int = 20) -> KMeansModel:
    """k-means over pickups and dropoffs of train and test together."""
    points = VectorAssembler(inputCols=["lat", "lng"], outputCol="features").transform(stacked_points(df))
    estimator = KMeans(
        k=k, seed=seed, maxIter=max_iter, initMode="k-means||", featuresCol="features", weightCol="weight"
    )
    return estimator.fit(points.select("features", "weight"))


# Points of a batch, batches at most, rows that choose the first centres, and how many batches may pass without gain
# of such a share of the cost.
BATCH = 262_144
BATCHES = 100
INIT_ROWS = 20_000
PATIENCE = 10
TOLERANCE = 1e-3


def _first_centres(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centres drawn one after another, with odds in proportion to weight and squared distance to those before.

    Of a few draws for each the one that leaves the least cost is kept.
    """
    centres = [points[rng.choice(len(points), p=weights / weights.sum())]]
    away = ((points - centres[0]) ** 2).sum(axis=1)
    tries = 2 + int(np.log(max(k, 1)))
    while len(centres) < min(k, len(points)):
        odds = away * weights
        if not odds.sum():
            break
        drawn = points[rng.choice(len(points), size=tries, p=odds / odds.sum())]
        left = np.minimum(away, ((points[None] - drawn[:, None]) ** 2).sum(axis=2))
        best = int(np.argmin(left @ weights))
        centres.append(drawn[best])
        away = left[best]
    return np.array(centres)


def fit_mini_batch_clusters(
    df: DataFrame, k: int = 100, seed: int = 1000, batch: int = BATCH, batches: int = BATCHES, patience: int = PATIENCE
) -> list[tuple[float, float]]:
    """Centres of k-means over pickups and dropoffs by small batches.

    The distinct points are written once, dealt by hash into folders of about ``batch`` points, and a
    step reads one folder only. It assigns the batch's points by the index over the centres, sums them per
    centre in one aggregate of at most k rows, and moves each centre by the share the batch has of all
    weight the centre has seen, so steps get smaller. The first centres are drawn from a sample of about
    ``INIT_ROWS`` points, by hash. Ends after ``batches`` steps, or when the smoothed cost per point has
    not fallen for ``patience`` steps and two rounds through the folders. No points, no centres.
    """
    spark = df.sparkSession
    points = materialise(stacked_points(df), "points")
    total = points.count()
    if not total:
        return []
    parts = max(1, -(-total // batch))
    hashed = F.xxhash64(F.lit(seed), "lat", "lng")
    dealt = materialise_parts(points.withColumn("part", F.pmod(hashed, F.lit(parts)).cast("int")), "part", "batches")
    keep = F.pmod(F.xxhash64(F.lit(seed + 1), "lat", "lng"), F.lit(1 << 30)) < int(min(1.0, INIT_ROWS / total) * (1 << 30))
    sample = points.where(keep).orderBy("lat", "lng").collect()
    sample = sample or points.orderBy("lat", "lng").limit(k).collect()
    rng = np.random.default_rng(seed)
    centres = _first_centres(np.array([(r["lat"], r["lng"]) for r in sample]), np.array([r["weight"] for r in sample]), k, rng)
    seen = np.zeros(len(centres))
    smooth, best, waited = None, np.inf, 0
    for step in range(batches):
        part = dealt.where(F.col("part") == step % parts)
        lat, lng = F.element_at(_centres(centres, 0), F.col("c") + 1), F.element_at(_centres(centres, 1), F.col("c") + 1)
        away = (F.col("lat") - lat) * (F.col("lat") - lat) + (F.col("lng") - lng) * (F.col("lng") - lng)
        placed = CentreIndex(centres).assign(part, {"c": (F.col("lat"), F.col("lng"))})
        sums = placed.groupBy("c").agg(
            F.sum("weight").alias("w"),
            F.sum(F.col("weight") * F.col("lat")).alias("lat"),
            F.sum(F.col("weight") * F.col("lng")).alias("lng"),
            F.sum(F.col("weight") * away).alias("cost"),
        )
        rows = sums.collect()  # at most one row per centre
        weight = sum(r["w"] for r in rows)
        if weight:
            for r in rows:
                seen[r["c"]] += r["w"]
                rate = r["w"] / seen[r["c"]]
                centres[r["c"]] += rate * (np.array([r["lat"], r["lng"]]) / r["w"] - centres[r["c"]])
            cost = sum(r["cost"] for r in rows) / weight
            share = min(1.0, 2.0 / (parts + 1))
            smooth = cost if smooth is None else smooth + share * (cost - smooth)
            waited = 0 if smooth < best * (1 - TOLERANCE) else waited + 1
            best = min(best, smooth)
        if waited >= max(patience, 2 * parts):
            break
    discard(points)
    return [tuple(map(float, c)) for c in centres]


def _centres(centres: np.ndarray, axis: int) -> Column:
    return array_constant(centres[:, axis].tolist(), "double")


def assign_to_centres(df: DataFrame, centres: Sequence[Sequence[float]], pickup: str, dropoff: str) -> DataFrame:
    """Number of the nearest of the given centres for both ends of each trip, the first of equally near ones.

    NULL without coordinates. Each end is compared with the centres its cell of a grid leaves, whose
    number does not grow with that of all centres.
    """
    ends = {name: (F.col(f"{end}_latitude"), F.col(f"{end}_longitude")) for end, name in zip(ENDS, (pickup, dropoff))}
    return CentreIndex(centres).assign(df, ends)


def clustering_cost(df: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Squared distance of all trip ends to their nearest centre, as a frame of one row (cost, points)."""
    points = stacked_points(df)
    placed = CentreIndex(centres).assign(points, {"c": (F.col("lat"), F.col("lng"))})
    table = np.asarray(centres)
    dy, dx = (F.col(n) - F.element_at(_centres(table, k), F.col("c") + 1) for k, n in enumerate(("lat", "lng")))
    return placed.agg(F.sum(F.col("weight") * (dy * dy + dx * dx)).alias("cost"), F.sum("weight").cast("bigint").alias("points"))


def assign_clusters(
    df: DataFrame, model: KMeansModel, pickup: str | None = None, dropoff: str | None = None
) -> DataFrame:
    """Nearest fitted centre of both ends of each trip. Trips without coordinates get NULL."""
    centres = model.clusterCenters()
    k = len(centres)
    return assign_to_centres(df, centres, pickup or schema.pickup_cluster(k), dropoff or schema.dropoff_cluster(k))


def mean_centres(df: DataFrame, pickup: str, dropoff: str, clusters: Sequence[int]) -> dict[int, tuple[float, float]]:
    """Mean point of the trip ends in each of the named clusters, for clusters that were not fitted here."""
    ends = [F.struct(F.col(n).alias("c"), F.col(f"{e}_latitude").alias("lat"), F.col(f"{e}_longitude").alias("lng")) for e, n in zip(ENDS, (pickup, dropoff))]
    points = df.select(F.inline(F.array(*ends))).where(F.col("c").isin(*clusters))
    return {r["c"]: (r["lat"], r["lng"]) for r in points.groupBy("c").agg(F.avg("lat").alias("lat"), F.avg("lng").alias("lng")).collect()}


def with_grid_clusters(
    df: DataFrame, south: float, west: float, step: float = 0.05, names: Sequence[str] = ("pickup_cell", "dropoff_cell")
) -> DataFrame:
    """Square cells in place of fitted clusters, for data where SQL must be able to state them."""
    return df.withColumns(
        {
            name: geo.grid_cell(F.col(f"{end}_latitude"), F.col(f"{end}_longitude"), south, west, step)
            for end, name in zip(ENDS, names)
        }
    )


def cluster_traffic(df: DataFrame, pickup: str, dropoff: str) -> DataFrame:
    """Pickups plus dropoffs per cluster, also for clusters seen at one end only."""
    return (
        df.select(F.explode(F.array(pickup, dropoff)).alias("cluster"))
        .where(F.col("cluster").isNotNull())
        .groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("traffic"))
    )


def heavy_clusters(traffic: DataFrame, quantile: float = 0.9) -> DataFrame:
    """Clusters whose traffic lies above the quantile, busiest first. One row per cluster goes in."""
    limit = traffic.agg(F.percentile("traffic", F.lit(quantile))).scalar()
    return traffic.where(F.col("traffic") > limit).orderBy(F.desc("traffic"), "cluster")


def with_heavy_cluster_distances(
    df: DataFrame, centres: Sequence[Sequence[float]] | Mapping[int, Sequence[float]], heavy: Sequence[int]
) -> DataFrame:
    """Distance and bearing from both ends of a trip to every heavy centre.

    At most k centres enter the plan as constants, so there is no join and trips stay in place.
    """
    added = {}
    for cluster in heavy:
        lat, lng = (F.lit(float(c)) for c in centres[cluster])
        for end in ENDS:
            here = F.col(f"{end}_latitude"), F.col(f"{end}_longitude")
            stem = f"{end}_heavy_traffic_cluster{cluster}"
            added[f"{stem}_haversine"] = geo.haversine_km(*here, lat, lng)
            added[f"{stem}_bearing"] = geo.bearing_degrees(*here, lat, lng)
    return df.withColumns(added)


def heavy_cluster_features(
    located: DataFrame, pickup: str, dropoff: str, quantile: float = 0.9, centres: Sequence[Sequence[float]] | None = None
) -> DataFrame:
    """Distances to the heavy clusters by trip id, for trips that already hold their clusters.

    ``centres`` are those of the fit that located the trips; without one, the mean points of the
    heavy clusters stand in.
    """
    traffic = cluster_traffic(located, pickup, dropoff)
    heavy = [r["cluster"] for r in heavy_clusters(traffic, quantile).collect()]  # at most one row per cluster
    points = centres if centres is not None else mean_centres(located, pickup, dropoff, heavy)
    ends = [f"{e}_{axis}" for e in ENDS for axis in ("latitude", "longitude")]
    return with_heavy_cluster_distances(located.select("id", *ends), points, heavy).drop(*ends)
