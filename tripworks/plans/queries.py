"""Registered queries: each runs one operator over the whole given tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripworks.functions import calendar, geo, numeric
from tripworks.functions.numeric import round_half_even
from tripworks.operators import cluster, enrich, features, nearest, profile, rows, stats, traffic
from tripworks.operators.nearest import CentreIndex
from tripworks.plans import feature_build, modelling
from tripworks.plans.extra_trees import ExtraTrees
from tripworks.session import prepare
from tripworks.sources import files, fixtures, schema, sinks
from tripworks.sources.scratch import materialise, scratch_root
from tripworks.sources.stages import BucketedFeatures, FeatureCache, StageStore, join_features

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

CELLS = ("pickup_cell", "dropoff_cell")
WINDOWS = (10, 15, 1440)
COORDINATES = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
FEATURES_CHECKED = ("vendor_id", "passenger_count", *COORDINATES, "lat_long_distance_haversine")


# Directions between rotated points carry the rounding of the fitted angle: compare fewer decimals.
COARSE = {"pca_direction": 4}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles cut to ``digits`` decimals: engines differ in the last bits of sums and sines."""
    return df.select(
        *(
            (round_half_even(F.col(f.name), COARSE.get(f.name, digits)) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema
        )
    )


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(function(prepare(spark), sf_dir))

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    REGISTRY[function.__name__] = run
    return function


def _trips(spark, sf):
    return fixtures.trips(spark, sf)


def _train(df):
    return rows.only_split(df, schema.TRAIN)


def _dated(spark, sf):
    return features.with_calendar(_trips(spark, sf))


def _measured(spark, sf):
    """Trips with distances and target columns."""
    return features.with_targets(features.with_distances(_trips(spark, sf)))


def _celled(df):
    return cluster.with_grid_clusters(df, fixtures.SOUTH, fixtures.WEST, names=CELLS)


def _grouped_base(spark, sf):
    """Everything the group statistics need, on grid cells in place of fitted clusters."""
    return _celled(features.with_location_bins(features.with_calendar(_measured(spark, sf))))


# --- rows -----------------------------------------------------------------------------------------


@query
def trips_base(spark, sf):
    train, test = _train(_trips(spark, sf)), rows.only_split(_trips(spark, sf), schema.TEST)
    return rows.encode_flag(
        rows.stack_splits(train.drop("split"), test.drop("split", "trip_duration", "dropoff_datetime"))
    )


@query
def numeric_id(spark, sf):
    return rows.with_numeric_id(_trips(spark, sf), target="id_number").select("id", "id_number")


@query
def narrow_types(spark, sf):
    df = rows.narrow_types(rows.encode_flag(_dated(spark, sf)))
    return df.select("id", *rows.NARROW_TYPES)


@query
def outlier_filter(spark, sf):
    df = rows.filter_outliers(_measured(spark, sf), max_distance=10.0, max_duration=3000.0)
    return df.select("id", "split", "trip_duration", "lat_long_distance_haversine")


@query
def zero_distance_trips(spark, sf):
    condition = F.col("lat_long_distance_haversine") == 0
    return rows.select_anomalies(_train(_measured(spark, sf)), condition, ["id", *COORDINATES, "trip_duration"])


@query
def far_trips(spark, sf):
    condition = F.col("lat_long_distance_haversine") > 15
    columns = ["id", *COORDINATES, "lat_long_distance_haversine", "trip_duration"]
    return rows.select_anomalies(_train(_measured(spark, sf)), condition, columns)


@query
def target_transforms(spark, sf):
    seconds = F.col("trip_duration")
    return _train(_trips(spark, sf)).select(
        "id",
        numeric.log_target(seconds).alias("log_target"),
        numeric.log1p_target(seconds).alias("log1p_target"),
        numeric.from_log_target(numeric.log_target(seconds)).alias("back"),
    )


@query
def systematic_sample(spark, sf):
    return rows.systematic_sample(_trips(spark, sf), 10).select("id", "split", "trip_duration")


@query
def every_nth_row(spark, sf):
    """Exactly every tenth trip in order of time and id."""
    return rows.every_nth(_trips(spark, sf), 10, ["pickup_datetime", "id"]).select("id", "split", "trip_duration")


@query
def shuffled_rows(spark, sf):
    return rows.shuffle_rows(_trips(spark, sf), seed=3).select("id", "trip_duration")


# --- files ----------------------------------------------------------------------------------------


def _folder(spark, name):
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _csv(df, path):
    """As such files come: a header, times as text."""
    times = {f.name: F.date_format(f.name, files.TIMESTAMP_FORMAT) for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)}
    df.withColumns(times).write.option("header", True).csv(path)
    return path


@query
def csv_trips(spark, sf):
    """Trips written as train and test files and read again; the test file lacks two columns and has another order."""
    trips, folder = _trips(spark, sf), _folder(spark, "trips")
    train = _csv(_train(trips).select(*schema.TRAIN_TRIPS.names), f"{folder}/train")
    test = _csv(rows.only_split(trips, schema.TEST).select(*reversed(schema.TEST_TRIPS.names)), f"{folder}/test")
    return files.read_trips(spark, train, test)


@query
def csv_routes(spark, sf):
    """First and second routes from two files each; columns the tables lack are empty."""
    routes, folder = fixtures.routes(spark, sf), _folder(spark, "routes")
    wide = routes.select(*(F.col(n) if n in routes.columns else F.lit(None).cast("string").alias(n) for n in schema.ROUTES.names))
    odd = F.crc32("id") % 2 == 1
    paths = [_csv(wide.where(odd), f"{folder}/one"), _csv(wide.where(~odd), f"{folder}/two")]
    second = files.read_second_routes(spark, paths).select("id", "second_starting_street", "second_total_distance", "second_number_of_steps")
    return files.read_routes(spark, paths).drop("step_direction").join(second, "id")


@query
def csv_weather(spark, sf):
    weather = fixtures.weather(spark, sf)
    wide = weather.select(*(F.col(n) if n in weather.columns else F.lit("0").alias(n) for n in schema.WEATHER.names))
    return files.read_weather(spark, _csv(wide.toDF(*"abcdefg"), _folder(spark, "weather"))).select(*weather.columns, "average_temperature")


@query
def csv_accidents(spark, sf):
    """Injured persons per report, in a file with other columns beside."""
    injured = F.when(F.col("l_linenumber") < 6, F.col("l_linenumber"))
    reports = fixtures.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("BOROUGH"), injured.alias(schema.INJURED))
    found = files.read_accidents(spark, _csv(reports, _folder(spark, "accidents")))
    return profile.histogram(found, F.col(f"`{schema.INJURED}`"), 1)


@query
def csv_bad_rows(spark, sf):
    """Rows of a file that cannot be read, by reason, and those that can, add up to the file's."""
    train, key = _train(_trips(spark, sf)).select(*schema.TRAIN_TRIPS.names), rows.numeric_id(F.col("id"))
    faulty = train.withColumns(
        {
            "passenger_count": F.when(key % 50 == 1, F.lit("many")).otherwise(F.col("passenger_count").cast("string")),
            "pickup_datetime": F.when(key % 70 == 2, F.lit("2016-13-01 00:00:00")).otherwise(F.date_format("pickup_datetime", files.TIMESTAMP_FORMAT)),
            "pickup_latitude": F.when(key % 90 == 3, F.lit("nan")).otherwise(F.col("pickup_latitude").cast("string")),
        }
    )
    good, bad = files.read_checked(spark, _csv(faulty, _folder(spark, "faulty")), schema.TRAIN_TRIPS)
    kinds = bad.select(F.array_join(F.transform("reasons", lambda r: F.substring_index(r, ":", 1)), "+").alias("kind"))
    without = F.when(F.col("pickup_latitude").isNull(), "good, without a number").otherwise("good")
    return kinds.union(good.select(without)).groupBy("kind").agg(F.count(F.lit(1)).alias("cnt"))


@query
def stored_stages(spark, sf):
    """Stages written, one split of one replaced, and the latest read back."""
    trips = _trips(spark, sf).select("id", "split", "vendor_id")
    store = StageStore(spark, _folder(spark, "stages"))
    store.save(0, trips)
    store.save(2, trips)
    store.save_split(2, trips.withColumn("vendor_id", F.col("vendor_id") + 10), schema.TEST)
    return store.load(store.latest()).unionByName(store.load(0, schema.TRAIN).withColumn("id", F.concat(F.lit("first "), "id")))


@query
def written_predictions(spark, sf):
    """A submission, out-of-fold and fold predictions written and read back."""
    train, test = (rows.only_split(_trips(spark, sf), s) for s in (schema.TRAIN, schema.TEST))
    predicted = lambda df, by: df.select("id", (F.col("vendor_id") * by).alias("trip_duration"))
    folder = _folder(spark, "predictions")
    submission = sinks.write_submission(predicted(test, 1.5), folder, "model")
    both = sinks.write_out_of_fold(predicted(train, 2.5), predicted(test, 3.5), folder, "model")
    folds = sinks.write_fold_predictions(rows.assign_folds(predicted(test, 4.5)), folder, "model")
    read = [
        spark.read.option("header", True).schema("id string, trip_duration double").csv(submission).withColumn("sink", F.lit("submission")),
        spark.read.parquet(both).select("id", "trip_duration", F.concat(F.lit("out of fold "), "split").alias("sink")),
        spark.read.parquet(folds).select("id", "trip_duration", F.lit("folds").alias("sink")),
    ]
    return reduce(DataFrame.unionByName, read)


# --- splits ---------------------------------------------------------------------------------------


@query
def holdout_split(spark, sf):
    return rows.holdout_split(_train(_trips(spark, sf))).select("id", "part")


@query
def fold_assign(spark, sf):
    return rows.assign_folds(_train(_trips(spark, sf))).select("id", "fold")


@query
def zero_fill(spark, sf):
    return rows.fill_missing_with_zero(
        _trips(spark, sf).select("id", "passenger_count", "trip_duration", "store_and_fwd_flag")
    )


@query
def speed_columns(spark, sf):
    df = _train(_measured(spark, sf))
    km, seconds = F.col("lat_long_distance_haversine"), F.col("trip_duration")
    return df.select(
        "id",
        geo.speed(km, seconds, "km/h").alias("speed"),
        geo.speed(km, seconds, "km/s").alias("average_speed"),
        F.col("lat_long_avg_speed_h").alias("avg_speed_h"),
        F.col("lat_long_avg_speed_m").alias("avg_speed_m"),
    )


@query
def speed_filtered(spark, sf):
    speed = geo.speed(F.col("lat_long_distance_haversine"), F.col("trip_duration"), "km/h")
    return _train(_measured(spark, sf)).select("id", speed.alias("speed")).where(F.col("speed") < 100)


@query
def drop_sparse(spark, sf):
    return profile.drop_sparse_columns(_trips(spark, sf), 0.25, keep=("id", "split"))


@query
def first_trips(spark, sf):
    return rows.first_rows(_trips(spark, sf), 20, ["pickup_datetime", "id"]).select("id", "pickup_datetime", "vendor_id")


# --- geography ------------------------------------------------------------------------------------


@query
def geo_distance(spark, sf):
    df = _measured(spark, sf)
    return df.select("id", *(c for c in df.columns if c.startswith("lat_long_") and "avg" not in c))


@query
def location_bins(spark, sf):
    df = features.with_location_bins(_measured(spark, sf))
    return df.select("id", *(c for c in df.columns if c.endswith("_bin")))


@query
def great_circle_miles(spark, sf):
    return features.with_great_circle_miles(_trips(spark, sf)).select("id", "osmnx_distance")


@query
def pca_coords(spark, sf):
    df = features.with_distances(features.with_pca(_trips(spark, sf)), "pca0", "pca1", "pca_")
    return df.select("id", *(c for c in df.columns if "pca" in c))


@query
def bounding_box(spark, sf):
    return features.bounding_box(_trips(spark, sf))


@query
def city_window(spark, sf):
    here = geo.in_window(F.col("pickup_latitude"), F.col("pickup_longitude"), 40.63, 40.75, -74.03, -73.9)
    return _trips(spark, sf).where(here).select("id", "pickup_latitude", "pickup_longitude")


# --- calendar -------------------------------------------------------------------------------------


@query
def calendar_parts(spark, sf):
    added = (
        "pickup_month pickup_day pickup_hour pickup_weekofyear pickup_weekday pickup_week_hour is_weekend "
        "pickup_time_delta pickup_week_delta pickup_week_delta_sin pickup_hour_sin"
    )
    return _dated(spark, sf).select("id", *added.split())


@query
def round_hour(spark, sf):
    nearest = calendar.round_to_hour(F.col("pickup_datetime"))
    return _trips(spark, sf).select("id", nearest.alias("pickup_datetime_group"))


@query
def binary_flags(spark, sf):
    return features.with_binary_flags(_dated(spark, sf)).select("id", "is_passenger_alone", "is_midnight")


@query
def holiday_flags(spark, sf):
    return features.with_holidays(_dated(spark, sf)).select("id", "is_holyday", "is_day_before_holyday")


# --- group statistics -----------------------------------------------------------------------------


@query
def bin_speed(spark, sf, min_count=100):
    """Mean speed and number of training trips per pickup bin."""
    df = features.with_location_bins(_measured(spark, sf))
    measures = {"avg_speed_h": F.col("lat_long_avg_speed_h"), "avg_speed_m": F.col("lat_long_avg_speed_m")}
    return stats.group_means(
        _train(df), ["pickup_latitude_bin", "pickup_longitude_bin"], measures, min_count=min_count
    )


@query
def group_mean_single(spark, sf):
    df = _grouped_base(spark, sf)
    sets = stats.single_key_sets(*CELLS, None)
    return stats.with_group_features(df, sets).select("id", *(n for s in sets for n in s.attach.values()))


@query
def group_stats_multi(spark, sf):
    df = _grouped_base(spark, sf)
    sets = stats.multi_key_sets(*CELLS, None)
    return stats.with_group_features(df, sets).select("id", *(n for s in sets for n in s.attach.values()))


@query
def group_mean_leave_one_out(spark, sf):
    df = _grouped_base(spark, sf)
    sets = [s for s in stats.single_key_sets(*CELLS, None) if s.keys[0] in ("pickup_hour", CELLS[0])]
    out = stats.with_group_features(df, sets, leave_one_out=True)
    return out.select("id", *(n for s in sets for n in s.attach.values()))


@query
def vendor_profile(spark, sf):
    levels = [("vendor_id", "pickup_weekday"), ("vendor_id", "pickup_hour")]
    return stats.group_means_by_level(
        _train(_dated(spark, sf)), levels, {"trip_duration": F.col("trip_duration")}
    )


@query
def vendor_weekday_lookup(spark, sf):
    return stats.with_vendor_weekday_mean(_dated(spark, sf)).select("id", "groupby_vi_pweekdat_trip_duration")


@query
def mean_by_calendar(spark, sf):
    levels = [("pickup_month",), ("pickup_day",), ("pickup_hour",), ("pickup_weekday",)]
    return stats.group_means_by_level(
        _train(_dated(spark, sf)), levels, {"trip_duration": F.col("trip_duration")}
    )


@query
def speed_by_time(spark, sf):
    df = _train(features.with_calendar(_measured(spark, sf)))
    km, seconds = F.col("lat_long_distance_haversine"), F.col("trip_duration")
    measures = {
        "speed": geo.speed(km, seconds, "km/h"),
        "distance": km,
        "duration": seconds,
        "avg_speed_h": F.col("lat_long_avg_speed_h"),
    }
    return stats.group_means_by_level(df, [("pickup_hour",), ("pickup_weekday",), ("pickup_week_hour",)], measures)


@query
def passenger_profile(spark, sf):
    measures = {"trip_duration": F.col("trip_duration"), "distance": F.col("lat_long_distance_haversine")}
    known = _train(_measured(spark, sf)).where(F.col("passenger_count").isNotNull())
    return stats.group_means(known, ["passenger_count"], measures)


@query
def cluster_speed(spark, sf):
    """Mean speed by pickup cell beside mean speed by dropoff cell, for cells seen at either end."""
    df = _train(_celled(_measured(spark, sf)))
    speed = geo.speed(F.col("lat_long_distance_haversine"), F.col("trip_duration"), "km/s")
    ends = [
        stats.group_means(df, [cell], {f"{cell}_speed": speed}).select(F.col(cell).alias("cell"), f"{cell}_speed")
        for cell in CELLS
    ]
    return ends[0].join(ends[1], "cell", "full")


# --- side tables ----------------------------------------------------------------------------------


@query
def street_encoding(spark, sf):
    df = enrich.join_routes(_trips(spark, sf), fixtures.routes(spark, sf))
    df = stats.with_street_encoding(df.select("id", "split", "trip_duration", "starting_street", "end_street"))
    return df.select("id", "starting_street_heavy", "end_street_heavy")


@query
def route_features(spark, sf):
    df = enrich.join_routes(_trips(spark, sf).select("id", "split"), fixtures.routes(spark, sf))
    return enrich.drop_route_steps(enrich.with_step_counts(enrich.with_step_ratios(df)))


@query
def notnull_steps(spark, sf):
    df = enrich.join_routes(_trips(spark, sf).select("id", "split"), fixtures.routes(spark, sf))
    return df.where(F.col("step_direction").isNotNull()).select("id", "split", "step_direction")


@query
def second_routes(spark, sf):
    routes = fixtures.routes(spark, sf)
    df = enrich.join_routes(_trips(spark, sf).select("id"), routes, rows.prefix_columns(routes, "second_"))
    return enrich.drop_route_steps(df, ("", "second_"))


@query
def weather_join(spark, sf):
    df = enrich.join_weather(_trips(spark, sf), fixtures.weather(spark, sf), enrich.TRACED_COLUMNS)
    return df.select("id", "pickup_datetime", *enrich.TRACED_COLUMNS)


@query
def step_count_distribution(spark, sf):
    df = enrich.with_step_counts(fixtures.routes(spark, sf))
    levels = [("steps_left_count",), ("steps_right_count",), ("steps_straight_count",), ("steps_none_count",)]
    return profile.counts_by_category(df, levels)


@query
def weather_counts(spark, sf):
    return profile.counts_by(enrich.daily_weather(fixtures.weather(spark, sf)), ["snow_fall"])


@query
def distinct_snow(spark, sf):
    return profile.distinct_values(fixtures.weather(spark, sf), "snow_fall")


# --- traffic --------------------------------------------------------------------------------------


@query
def pickup_window_traffic(spark, sf):
    df = traffic.with_pickup_traffic(_celled(_trips(spark, sf)), WINDOWS, CELLS[0])
    return df.select("id", *(c for c in df.columns if c.startswith("this_")))


@query
def dropoff_window_traffic(spark, sf):
    df = traffic.with_dropoff_traffic(_celled(_trips(spark, sf)), WINDOWS, CELLS[1])
    return df.select("id", *(c for c in df.columns if c.startswith("this_")))


@query
def dropoff_window_before(spark, sf):
    df = traffic.with_dropoff_traffic(_celled(_trips(spark, sf)), WINDOWS, CELLS[1], direction="before")
    return df.select("id", *(c for c in df.columns if c.startswith("this_")))


@query
def rolling_hour_count(spark, sf):
    events = fixtures.table(spark, sf, "events").select("event_id", "ts")
    return traffic.with_trailing_count(events, "ts", 60, spread="event_id").select("event_id", "count_60min")


@query
def rolling_trip_count(spark, sf):
    return traffic.with_trailing_count(_trips(spark, sf)).select("id", "count_60min")


@query
def cluster_traffic(spark, sf):
    return cluster.cluster_traffic(_celled(_trips(spark, sf)), *CELLS)


@query
def heavy_clusters(spark, sf):
    return cluster.heavy_clusters(cluster.cluster_traffic(_celled(_trips(spark, sf)), *CELLS), 0.8)


@query
def heavy_cell_distances(spark, sf):
    """Distances of every trip to the middles of the busy cells, one row per trip and cell."""
    df = _trips(spark, sf).select("id", *COORDINATES)
    heavy = cluster.heavy_clusters(cluster.cluster_traffic(_celled(df), *CELLS), 0.8)
    ids = [r["cluster"] for r in heavy.collect()]  # one row per heavy cell
    middles = {c: (fixtures.SOUTH + (c // 100 + 0.5) * 0.05, fixtures.WEST + (c % 100 + 0.5) * 0.05) for c in ids}
    wide = cluster.with_heavy_cluster_distances(df, middles, ids)
    names = {f"{e}_{m}": (e, m) for e in cluster.ENDS for m in ("haversine", "bearing")}
    each = [
        F.struct(F.lit(c).alias("cluster"), *(F.col(f"{e}_heavy_traffic_cluster{c}_{m}").alias(n) for n, (e, m) in names.items()))
        for c in ids
    ]
    return wide.select("id", F.inline(F.array(*each)))


# --- profiling ------------------------------------------------------------------------------------


@query
def missing_profile(spark, sf):
    return profile.missing_profile(_trips(spark, sf))


@query
def drift_check(spark, sf):
    return profile.drift_profile(_measured(spark, sf), FEATURES_CHECKED)


@query
def drift_worst(spark, sf):
    return profile.worst_drift(profile.drift_profile(_measured(spark, sf), FEATURES_CHECKED))


@query
def describe_duration(spark, sf):
    return profile.describe(_train(_measured(spark, sf)), ["trip_duration", "lat_long_distance_haversine"])


@query
def mode_impute(spark, sf):
    df = _trips(spark, sf).select("id", "passenger_count", "store_and_fwd_flag")
    return profile.impute_most_frequent(profile.impute_most_frequent(df, "passenger_count"), "store_and_fwd_flag")


@query
def constant_impute(spark, sf):
    df = _trips(spark, sf).select("id", "passenger_count", "store_and_fwd_flag")
    return profile.impute_constant(profile.impute_constant(df, "passenger_count", 0), "store_and_fwd_flag", "N")


@query
def lowcard_impute(spark, sf):
    df = _trips(spark, sf).select("id", "vendor_id", "passenger_count", "trip_duration", "pickup_latitude")
    return profile.impute_low_cardinality(df)


@query
def counts_by_category(spark, sf):
    df = _dated(spark, sf).withColumn("pickup_date", F.to_date("pickup_datetime"))
    names = "pickup_date vendor_id passenger_count store_and_fwd_flag pickup_month pickup_day pickup_hour pickup_weekday"
    return profile.counts_by_category(df, [*(("split", n) for n in names.split()), ("split", "pickup_weekday", "pickup_hour")])


@query
def histogram_duration(spark, sf):
    return profile.histogram(_train(_trips(spark, sf)), F.col("trip_duration"), 300)


@query
def histogram_log_duration(spark, sf):
    return profile.histogram(_train(_trips(spark, sf)), F.log1p("trip_duration"), 0.25)


@query
def histogram_distance(spark, sf):
    return profile.histogram(_train(_measured(spark, sf)), F.col("lat_long_distance_haversine"), 0.5)


@query
def histogram_speed(spark, sf):
    speed = geo.speed(F.col("lat_long_distance_haversine"), F.col("trip_duration"), "km/h")
    return profile.histogram(_train(_measured(spark, sf)).withColumn("speed", speed).where("speed < 100"), F.col("speed"), 5)


@query
def threshold_counts(spark, sf):
    return profile.threshold_counts(_train(_trips(spark, sf)))


@query
def density_duration(spark, sf):
    """Kernel density of the log duration by vendor."""
    return profile.density(_train(_trips(spark, sf)), F.log("trip_duration"), 4.0, 9.0, 100, 0.2, by=["vendor_id"])


@query
def duration_range(spark, sf):
    return profile.duration_range(_train(_trips(spark, sf)))


# --- models and whole jobs ------------------------------------------------------------------------


@query
def error_metrics(spark, sf):
    """Errors of the mean log duration by hour as a predictor, per fold and their mean."""
    train = rows.assign_folds(_train(_dated(spark, sf)))
    labelled = train.select("id", "fold", "pickup_hour", F.log("trip_duration").alias("label"))
    by_hour = stats.KeySet(("pickup_hour",), {"label": "prediction"}, max_groups=24)
    means = stats.grouped(labelled, [by_hour], {"label": F.col("label")})
    per_fold = modelling.error_metrics(stats.attach_statistics(labelled, means, [by_hour]), by=["fold"])
    named = per_fold.withColumn("fold", F.col("fold").cast("string"))
    return named.unionByName(modelling.fold_means(per_fold).withColumn("fold", F.lit("mean")))


def _grid_config(**settings):
    return feature_build.Config(
        locate=_celled, cluster_columns=CELLS, clusters=10_000, **settings
    )


def _grid_features(spark, sf, **settings):
    return feature_build.build_features(
        _trips(spark, sf), fixtures.routes(spark, sf), fixtures.weather(spark, sf), _grid_config(**settings)
    )


@query
def all_features(spark, sf):
    """Every feature of every trip, on grid cells so that SQL can state them too."""
    return _grid_features(spark, sf, great_circle=True, window_minutes=(10, 15))


@query
def kmeans_assign(spark, sf):
    df = _trips(spark, sf).select("id", *COORDINATES)
    model = cluster.fit_location_clusters(df, k=100, seed=1000, max_iter=10)
    return cluster.assign_clusters(df, model).drop(*COORDINATES)


# Centres that are given, so that SQL can state which is nearest.
GIVEN_CENTRES = [(40.64 + 0.035 * i, -74.01 + 0.045 * j) for i in range(5) for j in range(5)]


@query
def nearest_centres(spark, sf):
    df = _trips(spark, sf).select("id", *COORDINATES)
    return cluster.assign_to_centres(df, GIVEN_CENTRES, "pickup_centre", "dropoff_centre").drop(*COORDINATES)


@query
def kmeans_checks(spark, sf):
    """What must hold of fitted centres: each end is with its nearest, means are means, small batches come near the full fit."""
    df = _trips(spark, sf).select("id", *COORDINATES)
    full = cluster.fit_location_clusters(df, k=25, seed=1000, max_iter=20).clusterCenters()
    small = cluster.fit_mini_batch_clusters(df, k=25, seed=1000, batch=20_000)
    points = cluster.stacked_points(df)
    ends = F.col("lat"), F.col("lng")
    placed = CentreIndex(small).assign(points, {"c": ends}).withColumn("all", nearest.compared_with_all(*ends, [list(c) for c in small]))
    found = placed.agg(
        F.sum("weight").cast("bigint").alias("ends"),
        F.sum(F.when(F.col("c") == F.col("all"), F.col("weight")).otherwise(0)).cast("bigint").alias("with_nearest"),
        F.countDistinct("c").alias("clusters"),
    )
    costs = [cluster.clustering_cost(df, c).select(F.col("cost").alias(n)) for c, n in ((full, "full_cost"), (small, "small_cost"))]
    return found.join(costs[0]).join(costs[1]).select("ends", "with_nearest", "clusters", (F.col("small_cost") <= 1.1 * F.col("full_cost")).alias("near_full_fit"))


@query
def heavy_centre_distances(spark, sf):
    """Distances to the heavy ones of given centres, from trips located by them; one row per trip and heavy centre."""
    df = _trips(spark, sf).select("id", *COORDINATES)
    located = cluster.assign_to_centres(df, GIVEN_CENTRES, "pickup_centre", "dropoff_centre")
    wide = cluster.heavy_cluster_features(located, "pickup_centre", "dropoff_centre", 0.8, GIVEN_CENTRES)
    heavy = sorted({int(re.search(r"cluster(\d+)_", c)[1]) for c in wide.columns if c != "id"})
    each = [
        F.struct(F.lit(c).alias("centre"), *(F.col(f"{e}_heavy_traffic_cluster{c}_{m}").alias(f"{e}_{m}") for e in cluster.ENDS for m in ("haversine", "bearing")))
        for c in heavy
    ]
    return wide.select("id", F.inline(F.array(*each)))


@query
def heavy_cluster_distances(spark, sf):
    df = _trips(spark, sf).select("id", *COORDINATES)
    model = cluster.fit_location_clusters(df, k=20, seed=1000)
    located = cluster.assign_clusters(df, model, "pickup_cluster", "dropoff_cluster")
    return cluster.heavy_cluster_features(located, "pickup_cluster", "dropoff_cluster", 0.8, model.clusterCenters())


@query
def cached_traffic(spark, sf):
    """Window traffic built into a feature cache and joined to the trips from there."""
    trips = _trips(spark, sf)
    cache = FeatureCache(spark, f"{scratch_root(spark)}/features-{uuid.uuid4().hex}")
    cfg = _grid_config(window_minutes=(10, 15))
    build = lambda: feature_build.traffic_features(_celled(trips), cfg)
    kept = [cache.get("traffic", {"config": cfg.digest()}, build) for _ in range(2)]  # built once, read twice
    return join_features(trips.select("id", "split"), kept[1])


@query
def extended_distances(spark, sf):
    """Distances of most trips built into bucketed features, then those of all: the second build adds what is new."""
    trips, key = _trips(spark, sf).select("id", *COORDINATES), rows.numeric_id(F.col("id"))
    store = BucketedFeatures(spark, _folder(spark, "bucketed"), buckets=8)
    for build, part in enumerate((trips.where(key % 100 != 7), trips), 1):
        built = store.extend("distances", {"kind": "haversine"}, part, lambda df, n=build: features.with_distances(df).select("id", "lat_long_distance_haversine", F.lit(n).alias("build")))
    return built


def _model_input(spark, sf):
    df = features.with_calendar(features.with_distances(_trips(spark, sf)))
    return rows.encode_flag(df).drop("dropoff_datetime", "pickup_datetime")


HOUR = ["pickup_hour"]


@query
def oof_hour_mean(spark, sf):
    """Out-of-fold predictions of the mean log duration by hour, and its mean over the folds for test trips."""
    result = modelling.out_of_fold(_dated(spark, sf), modelling.GroupMean(weight=20.0), features=HOUR)
    held_out = result.train.select("id", "fold", "trip_duration", F.lit("train").alias("split"))
    return held_out.unionByName(result.test.withColumns({"fold": F.lit(None).cast("int"), "split": F.lit("test")}))


@query
def oof_hour_mean_by_fold(spark, sf):
    """What each fold's model predicts for the test trips."""
    return modelling.out_of_fold(_dated(spark, sf), modelling.GroupMean(weight=20.0), features=HOUR).per_fold


@query
def sweep_hour_mean(spark, sf):
    grid = {"weight": [0.0, 50.0, 5000.0]}
    return modelling.sweep(_dated(spark, sf), modelling.GroupMean(), grid, folds=3, features=HOUR)[1]


@query
def gbt_predict(spark, sf):
    learner = modelling.boosted_trees(rounds=5, depth=4)
    return modelling.boosted_predictions(_model_input(spark, sf), learner, folds=2)


@query
def oof_gbt(spark, sf):
    """All built features, as the learners take them, through all rounds of the boosted trees at full depth."""
    built = feature_build.model_input(_grid_features(spark, sf))
    result = modelling.out_of_fold(built, modelling.boosted_trees(), pack=True)
    both = [result.train.select("id", "trip_duration", F.lit("train").alias("split"))]
    return both[0].unionByName(result.test.withColumn("split", F.lit("test")))


@query
def oof_forest(spark, sf):
    result = modelling.out_of_fold(_model_input(spark, sf), modelling.bagged_trees(trees=10, depth=5))
    both = [result.train.select("id", "trip_duration", F.lit("train").alias("split"))]
    return both[0].unionByName(result.test.withColumn("split", F.lit("test")))


@query
def oof_extra_trees(spark, sf):
    """Randomised trees through the folds."""
    result = modelling.out_of_fold(_model_input(spark, sf), ExtraTrees(trees=5, depth=6, candidates=4))
    return result.train.select("id", "trip_duration", F.lit("train").alias("split")).unionByName(result.test.withColumn("split", F.lit("test")))


@query
def learner_checks(spark, sf):
    """What must hold of out-of-fold predictions: one per trip, errors of the size of the labels' spread, and for means of labels, within their range."""
    df = _model_input(spark, sf)
    learners = {"forest": modelling.bagged_trees(trees=5, depth=5), "boosted": modelling.boosted_trees(rounds=3, depth=4), "randomised": ExtraTrees(trees=5, depth=6, candidates=4)}
    durations = _train(df).agg(F.min("trip_duration").alias("low"), F.max("trip_duration").alias("high")).first()
    reports = []
    for name, learner in learners.items():
        result = modelling.out_of_fold(df, learner, folds=3)
        held_out = materialise(result.train.select("id", "fold", "label", "prediction"), "held-out")
        errors = held_out.agg(
            F.countDistinct("id").alias("trained"), F.count(F.lit(1)).alias("predicted"), F.countDistinct("fold").alias("folds"),
            (F.avg(modelling.squared_error(F.col("label"), F.col("prediction"))) < 2 * F.var_pop("label")).alias("error_bounded"),
        )
        slack = 1 + 1e-9
        inside = F.bool_and(F.col("trip_duration").between(durations["low"] / slack, durations["high"] * slack))
        tested = result.test.agg(F.countDistinct("id").alias("tested"), (inside if name != "boosted" else F.lit(True)).alias("in_range"))
        reports.append(errors.join(tested).withColumn("learner", F.lit(name)))
    return reduce(DataFrame.unionByName, reports)


@query
def param_sweep(spark, sf):
    learner = modelling.boosted_trees(rounds=2, depth=3)
    grid = {"maxDepth": [2, 4], "minInstancesPerNode": [1, 20]}
    return modelling.sweep(_model_input(spark, sf), learner, grid, folds=2)[1]
