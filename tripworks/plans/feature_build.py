"""The feature build from raw trips and side tables to model-ready features."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, functions as F

from tripworks.operators import cluster, enrich, features, profile, rows, stats, traffic
from tripworks.sources import schema
from tripworks.sources.scratch import materialise
from tripworks.sources.stages import FeatureCache, StageStore, content_identity, join_features

LAST_STAGE = 7
# The stage that adds clusters; later ones count on the trips as it located them.
LOCATED = 3


def _code_identity(function: Callable) -> str:
    """Name and code of a function that can be told apart from others by them."""
    code = getattr(function, "__code__", None)
    if code is None or "<" in function.__qualname__ or code.co_freevars:
        raise ValueError(f"only a named function of a module says what it does when its results are kept: {function!r}")
    seen = (code.co_code, code.co_names, code.co_varnames, [c for c in code.co_consts if isinstance(c, (str, int, float, tuple, type(None)))])
    return f"{function.__module__}.{function.__qualname__}.{hashlib.md5(repr(seen).encode()).hexdigest()[:8]}"


@dataclass(frozen=True)
class Config:
    """Parameters of the build; the defaults are those the features are known by."""

    clusters: int = 100
    cluster_seed: int = 1000
    cluster_iterations: int = 20
    min_count: int = 100
    max_missing_rate: float = 1.0
    # Takes the place of the years in the weather table, for trips of another year than its own.
    weather_year: int | None = None
    weekend_days: tuple[int, ...] = (0, 6)
    max_distance: float | None = None
    max_duration: float | None = None
    leave_one_out: bool = False
    # Optional steps.
    window_minutes: tuple[int, ...] = ()
    heavy_quantile: float | None = None
    great_circle: bool = False
    # Takes the place of fitted clusters if given: trips -> trips with both cluster columns.
    locate: Callable[[DataFrame], DataFrame] | None = None
    cluster_columns: tuple[str, str] | None = None

    # Keeps window traffic and heavy clusters between builds if given.
    cache: FeatureCache | None = None

    def digest(self) -> str:
        """Short name of all settings that decide what is built."""
        settings = {f.name: getattr(self, f.name) for f in fields(self) if f.name != "cache"}
        settings["locate"] = self.locate and _code_identity(self.locate)
        return hashlib.md5(repr(sorted(settings.items())).encode()).hexdigest()[:12]

    @property
    def pickup_cluster(self) -> str:
        return self.cluster_columns[0] if self.cluster_columns else schema.pickup_cluster(self.clusters)

    @property
    def dropoff_cluster(self) -> str:
        return self.cluster_columns[1] if self.cluster_columns else schema.dropoff_cluster(self.clusters)


def basic_features(trips: DataFrame, cfg: Config) -> DataFrame:
    """Rotated coordinates, calendar parts, distances and bins."""
    return _row_features(features.with_calendar(features.with_pca(trips), cfg.weekend_days))


def _row_features(df: DataFrame) -> DataFrame:
    """Distances and bins, which follow from the coordinates of a row alone."""
    df = features.with_distances(df)
    df = features.with_distances(df, "pca0", "pca1", "pca_")
    return features.with_location_bins(df)


def clean(df: DataFrame, cfg: Config) -> DataFrame:
    return rows.narrow_types(
        rows.filter_outliers(df, max_distance=cfg.max_distance, max_duration=cfg.max_duration)
    )


Centres = Sequence[Sequence[float]]


def locate(df: DataFrame, cfg: Config) -> tuple[DataFrame, Centres | None]:
    """Add cluster ids and targets, and tell the centres if they were fitted here.

    Everything after reads this frame more than once, so write it.
    """
    centres = None
    if cfg.locate is not None:
        located = cfg.locate(df)
    else:
        model = cluster.fit_location_clusters(df, cfg.clusters, cfg.cluster_seed, cfg.cluster_iterations)
        centres = model.clusterCenters()  # fewer than cfg.clusters if there are fewer points
        located = cluster.assign_to_centres(df, centres, cfg.pickup_cluster, cfg.dropoff_cluster)
    return materialise(features.with_targets(located), "located"), centres


def group_features(df: DataFrame, cfg: Config, located: DataFrame | None = None) -> DataFrame:
    """Single-key and multi-key statistics in one pass over the training rows, joined to all rows.

    ``located`` may give the trips to count where ``df`` has met other tables.
    """
    bound = cfg.clusters if cfg.locate is None else None  # nothing bounds ids that come from elsewhere
    key_sets = [
        *stats.single_key_sets(cfg.pickup_cluster, cfg.dropoff_cluster, bound),
        *stats.multi_key_sets(cfg.pickup_cluster, cfg.dropoff_cluster, bound, cfg.min_count),
    ]
    return stats.with_group_features(
        df, key_sets, leave_one_out=cfg.leave_one_out, keep_targets=False, source=located
    )


def drop_sparse(df: DataFrame, cfg: Config) -> DataFrame:
    if cfg.max_missing_rate >= 1.0:
        return df  # no share of missing values can be above 1
    return profile.drop_sparse_columns(df, cfg.max_missing_rate, keep=("id", "split", "trip_duration"))


def traffic_features(located: DataFrame, cfg: Config) -> DataFrame:
    """Traffic in the time windows by trip id, counted on the few columns it needs."""
    times = ("pickup_datetime", "dropoff_datetime")
    narrow = located.select("id", *times, cfg.pickup_cluster, cfg.dropoff_cluster)
    counted = traffic.with_pickup_traffic(narrow, cfg.window_minutes, cfg.pickup_cluster)
    counted = traffic.with_dropoff_traffic(counted, cfg.window_minutes, cfg.dropoff_cluster, source=narrow)
    return counted.drop(*times, cfg.pickup_cluster, cfg.dropoff_cluster)


def heavy_features(located: DataFrame, cfg: Config, centres: Centres | None = None) -> DataFrame:
    """Distances to the heavy clusters by trip id."""
    return cluster.heavy_cluster_features(located, cfg.pickup_cluster, cfg.dropoff_cluster, cfg.heavy_quantile, centres)


# Structs that hold what came by trip id until the step that shows it.
TRAFFIC, HEAVY, ROUTES = BY_ID = ("_traffic", "_heavy", "_routes")


def features_by_id(located: DataFrame, cfg: Config, centres: Centres | None = None) -> dict[str, DataFrame]:
    """On request window traffic and distances to heavy clusters, as narrow frames by trip id.

    They are counted on the located trips. With a cache they are kept there under the parameters they depend on.
    """
    def kept(name: str, build: Callable[[], DataFrame], **parameters) -> DataFrame:
        if cfg.cache is None:
            return build()
        return cfg.cache.get(name, {"config": cfg.digest(), **parameters}, build)

    found = {}
    if cfg.window_minutes:
        minutes = "-".join(map(str, cfg.window_minutes))
        found[TRAFFIC] = kept("traffic", lambda: traffic_features(located, cfg), minutes=minutes)
    if cfg.heavy_quantile is not None:
        build = lambda: heavy_features(located, cfg, centres)
        found[HEAVY] = kept("heavy_clusters", build, quantile=cfg.heavy_quantile)
    return found


def _shown(df: DataFrame, name: str) -> DataFrame:
    return df.select(*(F.col(c) for c in df.columns if c != name), f"{name}.*")


def other_features(
    df: DataFrame, cfg: Config, located: DataFrame | None = None, centres: Centres | None = None
) -> DataFrame:
    """Binary flags, and on request window traffic and distances to heavy clusters, unless ``df`` has met them."""
    df, met = features.with_binary_flags(df), [name for name in (TRAFFIC, HEAVY) if name in df.columns]
    for name in met:
        df = _shown(df, name)
    if not met:
        for by_id in features_by_id(located or df, cfg, centres).values():
            df = join_features(df, by_id)
    return df


def side_features(
    df: DataFrame, trips: DataFrame, routes: DataFrame, weather: DataFrame, cfg: Config
) -> DataFrame:
    """Route totals, street encodings, per-step ratios and the day's snow fall.

    The street means need only the raw trips and their routes, not the features built so far.
    """
    streets = enrich.join_routes(trips.select("id", "split", "trip_duration"), routes)
    df = enrich.with_step_ratios(_shown(df, ROUTES) if ROUTES in df.columns else enrich.join_routes(df, routes))
    df = enrich.drop_route_steps(stats.with_street_encoding(df, streets))
    return enrich.join_weather(df, weather, year=cfg.weather_year)


def final_features(df: DataFrame, cfg: Config) -> DataFrame:
    df = features.with_holidays(df)
    return features.with_great_circle_miles(df) if cfg.great_circle else df


def met_by_id(located: DataFrame, routes: DataFrame, cfg: Config, centres: Centres | None = None) -> DataFrame:
    """The located trips with all that comes by trip id, in structs under ``BY_ID``.

    The joins shuffle and sort the trips, by id once. What follows from the columns of a row alone stays behind and is made again
    after them, and the group statistics have yet to come, so rows are as narrow as they get.
    """
    ends = [f"{end}_{axis}" for end in cluster.ENDS for axis in ("latitude", "longitude", "pca0", "pca1")]
    needed = ("id", "pickup_datetime", "pickup_time_delta", "trip_duration", *ends)

    def with_row_features(df: DataFrame) -> DataFrame:
        df = features.with_calendar(df, cfg.weekend_days, time_delta=F.col("pickup_time_delta"))
        return features.with_targets(rows.narrow_types(_row_features(df)))

    again = set(with_row_features(located.select(*needed)).columns) - set(needed)
    # dealt out here, so that what follows has many tasks also where the joins would need no shuffle
    df = located.select(*(c for c in located.columns if c not in again)).repartition("id")
    # written first, these add a scan to the long plan that follows and not one of their own
    written = {name: materialise(by_id, "by-id") for name, by_id in features_by_id(located, cfg, centres).items()}
    for name, by_id in {**written, ROUTES: routes}.items():
        df = df.join(by_id.select("id", F.struct(*(c for c in by_id.columns if c != "id")).alias(name)), "id", "left")
    return with_row_features(df).select(*located.columns, *(c for c in df.columns if c in BY_ID))


def build_features(
    trips: DataFrame, routes: DataFrame, weather: DataFrame, cfg: Config = Config(), store: StageStore | None = None
) -> DataFrame:
    """All features of all trips, one row per trip of ``trips``.

    With a store, each stage is written under its number, apart for each configuration, together with
    the identity of the inputs by content and the centres fitted on the way. A finished stage of the same
    inputs is read back instead of being built again, and a build that goes on from any stage gives what
    one in a single run gives. Without inputs, the stages stored are taken as they are. Without a store
    only the frames that are read twice are written.
    """
    found: list = [None, None]  # located trips and their centres
    # the share of missing values is judged on trips as they are before they meet other tables
    meet_early = store is None and cfg.max_missing_rate >= 1.0
    if store is None:  # both the streets' means and the trips read the routes
        unread = set(schema.ROUTE_STEP_COLUMNS).difference(stats.STREETS)
        routes = materialise(routes.select(*(c for c in routes.columns if c not in unread)), "routes")

    def clusters_and_groups(df: DataFrame) -> DataFrame:
        found[:] = located, centres = locate(df, cfg)
        if meet_early:
            return group_features(met_by_id(located, routes, cfg, centres), cfg, located)
        return group_features(located, cfg)

    steps: list[Callable[[DataFrame], DataFrame]] = [
        rows.encode_flag,
        lambda df: basic_features(df, cfg),
        lambda df: clean(df, cfg),
        clusters_and_groups,
        lambda df: drop_sparse(df, cfg),
        lambda df: other_features(df, cfg, *found),
        lambda df: side_features(df, trips, routes, weather, cfg),
        lambda df: final_features(df, cfg),
    ]
    df = trips
    if store is None:
        for step in steps:
            df = step(df)
        return df
    store = store.under(cfg.digest())
    inputs = None if trips is None else [content_identity(x) for x in (trips, routes, weather)]
    done = store.latest(lambda n: n <= LAST_STAGE and inputs in (None, store.notes(n).get("inputs")))
    done = -1 if done is None else done
    if done >= 0:
        df = store.load(done)
    if LOCATED <= done < LAST_STAGE:
        # the stage holds the rows as they were located, with more columns than what follows looks at
        ends = [f"{e}_{x}" for e in cluster.ENDS for x in ("datetime", "latitude", "longitude")]
        found[:] = store.load(LOCATED).select("id", *ends, cfg.pickup_cluster, cfg.dropoff_cluster), store.notes(done)["centres"]
    for number in range(done + 1, len(steps)):
        built = steps[number](df)
        centres = None if found[1] is None else [list(map(float, c)) for c in found[1]]
        store.save(number, built, {"inputs": inputs, "centres": centres})
        df = store.load(number)
    return df


def model_input(df: DataFrame) -> DataFrame:
    """Features without the raw times, as the learners take them."""
    return df.drop(*(c for c in schema.MODEL_DROPPED if c in df.columns))

