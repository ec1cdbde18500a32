"""CSV readers, stage storage, caches and sinks on temporary directories."""

import datetime as dt
import glob
import gzip
import math

import pytest
from pyspark.sql import functions as F

from tripworks.operators import profile
from tripworks.sources import files, fixtures, hadoop, schema, scratch, sinks
from tripworks.sources.stages import BucketedFeatures, FeatureCache, StageStore, join_features

TRAIN_CSV = """id,vendor_id,pickup_datetime,dropoff_datetime,passenger_count,pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude,store_and_fwd_flag,trip_duration
id1,2,2016-03-14 17:24:55,2016-03-14 17:32:30,1,-73.98,40.76,-73.96,40.77,N,455
id2,1,2016-06-12 00:43:35,2016-06-12 00:54:38,,-73.98,40.73,,40.73,Y,663
"""
TEST_CSV = """id,pickup_datetime,vendor_id,passenger_count,pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude,store_and_fwd_flag
id3,2016-06-30 23:59:58,1,1,-73.98,40.73,-73.99,40.75,N
"""
ROUTE_HEAD = "id,starting_street,end_street,total_distance,total_travel_time,number_of_steps,street_for_each_step,distance_per_step,travel_time_per_step,step_maneuvers,step_direction,step_location_list\n"


def write(folder, name, text):
    path = f"{folder}/{name}"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_trips_from_csv(spark, folder):
    df = files.read_trips(spark, write(folder, "train.csv", TRAIN_CSV), write(folder, "test.csv", TEST_CSV))
    rows = {r["id"]: r for r in df.collect()}
    assert rows["id1"]["pickup_datetime"] == dt.datetime(2016, 3, 14, 17, 24, 55)
    assert rows["id2"]["dropoff_longitude"] is None and rows["id2"]["passenger_count"] is None
    # The test file orders its columns differently and lacks two.
    assert rows["id3"]["vendor_id"] == 1 and rows["id3"]["split"] == "test"
    assert rows["id3"]["trip_duration"] is None and rows["id3"]["dropoff_datetime"] is None


def test_bad_rows_are_kept_with_their_reasons(spark, folder):
    head, one, two = TRAIN_CSV.splitlines()
    lines = [one, two, one.replace(",1,-73.98", ",one,-73.98x"), two.replace("2016-06-12", "2016-06-32", 1), one + ",more", "id9,1", one.replace("-73.98", "nan")]
    paths = [write(folder, "a.csv", "\n".join([head, *lines])), write(folder, "b.csv", head + "\n" + one + "\n")]
    good, bad = files.read_checked(spark, paths, schema.TRAIN_TRIPS)
    assert good.schema.names == schema.TRAIN_TRIPS.names and good.count() == 4
    assert sorted(r["pickup_longitude"] is None for r in good.collect()) == [False, False, False, True]
    found = sorted((tuple(r["reasons"]), r["line"]) for r in bad.collect())
    assert [reasons for reasons, _ in found] == [("fields",), ("fields",), ("passenger_count: one", "pickup_longitude: -73.98x"), ("pickup_datetime: 2016-06-32 00:43:35",)]
    assert {line for reasons, line in found if reasons == ("fields",)} == {one + ",more", "id9,1"}
    assert all(r["file"].endswith("a.csv") for r in bad.collect())


def test_routes_from_several_parts(spark, folder):
    one = write(folder, "r1.csv", ROUTE_HEAD + "id1,A,B,1000.5,60.0,4,a|b,1|2,3|4,turn,left|none,x\n")
    two = write(folder, "r2.csv", ROUTE_HEAD + "id2,C,D,10,6,2,,,,,,\n")
    assert files.read_routes(spark, [one, two]).count() == 2
    second = files.read_second_routes(spark, [one, two])
    assert second.columns[:3] == ["id", "second_starting_street", "second_end_street"]


def test_weather_is_read_by_position(spark, folder):
    path = write(folder, "w.csv", "date,max,min,avg,prec,fall,depth\n1-1-2016,42,34,38.0,0.00,T,T\n")
    row = files.read_weather(spark, path).first()
    assert row["snow_fall"] == "T" and row["maximum_temerature"] == "42"


def test_accident_histogram(spark, folder):
    body = "BOROUGH,NUMBER OF PERSONS INJURED\nX,0\nX,0\nY,3\nZ,\n"
    df = files.read_accidents(spark, write(folder, "a.csv", body))
    bins = profile.histogram(df, F.col(f"`{schema.INJURED}`"), 1).collect()
    assert {r["bin"]: r["cnt"] for r in bins} == {0: 2, 3: 1}


def test_nan_becomes_null(spark):
    df = schema.nan_to_null(spark.createDataFrame([(math.nan, "a"), (1.0, None)], "x double, y string"))
    assert [tuple(r) for r in df.collect()] == [(None, "a"), (1.0, None)]


def test_stage_store(spark, folder):
    store = StageStore(spark, folder)
    assert store.latest() is None
    with pytest.raises(FileNotFoundError):
        store.load(0)
    both = spark.createDataFrame([("a", "train"), ("b", "test")], "id string, split string")
    store.save(0, both)
    store.save(3, both)
    assert store.latest() == 3 and store.load(3, "train").count() == 1
    store.save_split(3, spark.createDataFrame([("c", "train"), ("d", "train")], "id string, split string"), "train")
    assert store.latest() == 3
    assert sorted(r["id"] for r in store.load(3).collect()) == ["b", "c", "d"]
    assert store.ensure(3, lambda: pytest.fail("a finished stage is not built again")).count() == 3
    plan = store.load(3, "train")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_a_killed_write_is_not_seen(spark, folder):
    store = StageStore(spark, folder)
    both = spark.createDataFrame([("a", "train"), ("b", "test")], "id string, split string")
    store.save(1, both, {"from": "x"})
    failing = spark.range(50).selectExpr("if(id = 49, raise_error('lost'), string(id)) as id", "'train' as split")
    with pytest.raises(Exception):
        store.save(1, failing)
    with pytest.raises(Exception):
        store.save_split(1, failing, "train")
    assert store.exists(1) and store.notes(1) == {"from": "x"} and sorted(r["id"] for r in store.load(1).collect()) == ["a", "b"]
    # files lost or cut short since
    name = next(iter(next(iter(store.record(1)["parts"].values()))["files"]))
    (path,) = glob.glob(f"{folder}/stage_1/*/{name}")
    with open(path, "wb"):
        pass
    assert not store.exists(1) and store.latest() is None


def test_feature_cache(spark, folder):
    cache = FeatureCache(spark, folder)
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([("a", 1)], "id string, f int")

    cache.get("traffic", {"minutes": 10}, build)
    again = cache.get("traffic", {"minutes": 10}, build)
    cache.get("traffic", {"minutes": 15}, build)
    assert len(built) == 2
    trips = spark.createDataFrame([("a",), ("z",)], "id string")
    assert {r["id"]: r["f"] for r in join_features(trips, again).collect()} == {"a": 1, "z": None}


def test_bucketed_features_build_what_is_new_and_join_without_a_shuffle(spark, folder):
    store, seen = BucketedFeatures(spark, folder, buckets=4), []
    trips = spark.range(500).selectExpr("string(id) as id", "id as n")

    def build(df):
        seen.append(df.count())
        return df.selectExpr("id", "n * 2 as twice")

    store.extend("twice", {"by": 2}, trips.where("n < 490"), build)
    found = store.extend("twice", {"by": 2}, trips, build)
    assert seen == [490, 10] and found.agg(F.sum("twice")).first()[0] == 499 * 500
    other = store.extend("thrice", {}, trips, lambda df: df.selectExpr("id", "n * 3 as thrice"))
    joined = found.hint("merge").join(other, "id")
    assert joined.where("thrice * 2 = twice * 3").count() == 500
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    # another session does not know the table, but finds it
    spark.sql(f"drop table {store._table(store.path('twice', {'by': 2}))}")
    again = BucketedFeatures(spark, folder, buckets=4).extend("twice", {"by": 2}, trips, build)
    assert seen[-1] == 0 and again.count() == 500


def test_sinks(spark, folder):
    predictions = spark.createDataFrame([("a", 1.5), ("b", 2.5)], "id string, trip_duration double").coalesce(1)
    path = sinks.write_submission(predictions, folder, "boosted", dt.datetime(2020, 1, 2, 3, 4, 5))
    assert path.endswith("boosted_submission_2020_01_02_03_04_05")
    (part,) = glob.glob(f"{path}/*.csv.gz")
    with gzip.open(part, "rt") as f:
        assert f.read() == "id,trip_duration\na,1.5\nb,2.5\n"
    oof = sinks.write_out_of_fold(predictions, predictions, folder, "boosted")
    assert spark.read.parquet(oof).groupBy("split").count().count() == 2
    folds = sinks.write_fold_predictions(predictions.withColumn("fold", F.lit(3)), folder, "boosted")
    assert spark.read.parquet(folds).where("fold = 3").count() == 2


def test_scratch_tables_land_in_the_shared_folder(spark):
    df = scratch.materialise(spark.range(3), "three")
    assert df.inputFiles()[0].removeprefix("file://").startswith(scratch.scratch_root(spark))


def test_ids_stay_unique_above_seven_digits(spark):
    keys = spark.createDataFrame([(5,), (12345678,), (123456789,)], "k long")
    assert [r[0] for r in keys.coalesce(1).select(fixtures._trip_id(F.col("k"))).collect()] == ["id0000005", "id12345678", "id123456789"]


def test_daily_weather_turns_traces_into_numbers(spark, folder):
    from tripworks.operators import enrich

    body = "date,max,min,avg,prec,fall,depth\n2-1-2016,42,34,38.0,0.25,T,T\n1-1-2016,40,30,35.5,T,1.5,0\n"
    weather = files.read_weather(spark, write(folder, "w.csv", body))
    rows = {r["pickup_date"].day: r for r in enrich.daily_weather(weather).collect()}
    assert (rows[2]["precipitation"], rows[2]["snow_fall"], rows[2]["snow_depth"]) == (0.25, -1.0, -1.0)
    assert (rows[1]["precipitation"], rows[1]["snow_fall"], rows[1]["average_temperature"]) == (-1.0, 1.5, 35.5)
    trips = spark.createDataFrame([("a", dt.datetime(2016, 1, 1, 23, 59)), ("b", dt.datetime(2016, 1, 3))], "id string, pickup_datetime timestamp_ntz")
    joined = enrich.join_weather(trips, weather)
    assert joined.columns == ["id", "pickup_datetime", "snow_fall"]
    assert {r["id"]: r["snow_fall"] for r in joined.collect()} == {"a": 1.5, "b": None}


def test_weather_keeps_one_row_per_trip(spark):
    from tripworks.operators import enrich

    days = [("3-1-2016", "2"), ("3-1-2015", "9"), ("3-1-2016", "4"), ("2016-01-03", "7"), ("31-2-2016", "7"), ("x", "7"), (None, "7")]
    weather = spark.createDataFrame(days, "date string, snow_fall string")
    trips = spark.createDataFrame([("a", dt.datetime(2016, 1, 3, 5))], "id string, pickup_datetime timestamp_ntz")
    assert [r["snow_fall"] for r in enrich.join_weather(trips, weather).collect()] == [3.0]
    assert [r["snow_fall"] for r in enrich.join_weather(trips, weather, year=2016).collect()] == [5.0]
    assert enrich.unparsed_days(weather).count() == 4


def test_whole_numbers_written_as_decimals(spark, folder):
    path = write(folder, "a.csv", "x,NUMBER OF PERSONS INJURED\n1,1.0\n2,\n3,7\n4,NaN\n5,9007199254740993\n")
    assert [r[0] for r in files.read_accidents(spark, path).collect()] == [1, None, 7, None, 9007199254740993]
    bad = write(folder, "b.csv", "x,NUMBER OF PERSONS INJURED\n1,1.5\n")
    with pytest.raises(Exception, match="not a whole number"):
        files.read_accidents(spark, bad).collect()


def test_scratch_is_kept_in_the_shared_folder_and_cleared(spark, folder, monkeypatch):
    shared = spark.conf.get(scratch.SETTING)
    assert scratch.scratch_root(spark) == f"{shared}/tripworks-{spark.sparkContext.applicationId}"
    monkeypatch.setattr(scratch, "scratch_root", lambda spark: f"{folder}/own")
    kept = scratch.materialise(spark.range(5), "five")
    assert kept.count() == 5 and kept.inputFiles()[0].startswith(f"file://{folder}/own/five-")
    scratch.clear_scratch(spark)
    assert not hadoop.exists(spark, f"{folder}/own")
