"""Hand-computed values of the column functions."""

import datetime as dt
import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tripworks.functions import calendar, geo, numeric, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def many(spark, rows, schema, column):
    return [r["x"] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column.alias("x")).collect()]


def lits(*values):
    return [F.lit(v) for v in values]


def test_haversine_of_a_degree(spark):
    degree = 6371 * math.pi / 180
    assert one(spark, geo.haversine_km(*lits(0.0, 0.0, 1.0, 0.0))) == pytest.approx(degree)
    assert one(spark, geo.haversine_km(*lits(0.0, 0.0, 0.0, 1.0))) == pytest.approx(degree)
    assert one(spark, geo.haversine_km(*lits(40.7, -74.0, 40.7, -74.0))) == 0.0
    assert one(spark, geo.haversine_km(*lits(0.0, 0.0, 0.0, 180.0))) == pytest.approx(6371 * math.pi)


def test_manhattan_is_two_legs(spark):
    degree = 6371 * math.pi / 180
    assert one(spark, geo.manhattan_km(*lits(0.0, 0.0, 1.0, 1.0))) == pytest.approx(2 * degree)
    north_only = one(spark, geo.manhattan_km(*lits(60.0, 10.0, 61.0, 10.0)))
    assert north_only == pytest.approx(degree)


def test_bearing_of_the_four_winds(spark):
    winds = {(1.0, 0.0): 0.0, (0.0, 1.0): 90.0, (-1.0, 0.0): 180.0, (0.0, -1.0): -90.0, (0.0, 0.0): 0.0}
    for (lat, lng), degrees in winds.items():
        assert one(spark, geo.bearing_degrees(*lits(0.0, 0.0, lat, lng))) == pytest.approx(degrees)


def test_miles_use_their_own_radius(spark):
    km = 6371.009 * math.pi / 180
    assert one(spark, geo.great_circle_miles(*lits(0.0, 0.0, 1.0, 0.0))) == pytest.approx(km / 1.609344)


def test_bins_round_ties_to_even(spark):
    found = many(spark, [(40.765,), (-73.985,), (0.125,), (40.764,), (None,)], "c double", geo.location_bin(F.col("c")))
    assert found == [40.76, -73.98, 0.12, 40.76, None]


def test_speed_of_a_zero_second_trip_is_missing(spark):
    rows = [(3.6, 3600), (1.0, 0)]
    assert many(spark, rows, "km double, s long", geo.speed(F.col("km"), F.col("s"))) == [1.0, None]
    assert many(spark, rows, "km double, s long", geo.speed(F.col("km"), F.col("s"), "km/h")) == [3.6, None]
    with pytest.raises(ValueError):
        geo.speed(F.lit(1.0), F.lit(1), "mph")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(*(st.floats(-80, 80), st.floats(-170, 170)) * 2), min_size=1, max_size=20))
def test_distance_and_bearing_properties(spark, points):
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    there = geo.haversine_km(*(F.col(x) for x in "abcd"))
    back = geo.haversine_km(*(F.col(x) for x in "cdab"))
    rows = df.select(there.alias("t"), back.alias("u"), geo.bearing_degrees(*(F.col(x) for x in "abcd")).alias("w")).collect()
    for r in rows:
        assert r["t"] >= 0 and r["t"] == pytest.approx(r["u"], abs=1e-6)
        assert -180 <= r["w"] <= 180


STAMPS = "ts timestamp_ntz"


def test_round_to_hour_takes_half_past_to_even(spark):
    rows = [(dt.datetime(1970, 1, 1, h, 30),) for h in (0, 1, 2)] + [(dt.datetime(2016, 3, 14, 17, 24, 55),)]
    found = many(spark, rows, STAMPS, calendar.round_to_hour(F.col("ts")))
    assert [f.hour for f in found] == [0, 2, 2, 17]


def test_weekend_defaults_to_monday_and_sunday(spark):
    days = [(d,) for d in range(7)]
    assert many(spark, days, "d int", calendar.is_weekend(F.col("d"))) == [1, 0, 0, 0, 0, 0, 1]
    assert many(spark, days, "d int", calendar.is_weekend(F.col("d"), (5, 6))) == [0, 0, 0, 0, 0, 1, 1]


def test_half_wave(spark):
    assert one(spark, calendar.half_wave(F.lit(12), 24)) == pytest.approx(1.0)
    assert one(spark, calendar.half_wave(F.lit(0), 24)) == 0.0
    assert one(spark, calendar.week_position(F.lit(2), F.lit(6), F.lit(30))) == pytest.approx(2 + 6.5 / 24)


def test_all_holidays_of_2016(spark):
    days = [dt.datetime(2016, 1, 1) + dt.timedelta(days=i) for i in range(366)]
    df = spark.createDataFrame([(d,) for d in days], STAMPS)
    parts = F.month("ts"), F.dayofmonth("ts"), F.weekday("ts")
    rows = df.select("ts", calendar.is_holiday(*parts).alias("h"), calendar.is_holiday_eve(*parts).alias("e")).collect()
    holidays = {(r["ts"].month, r["ts"].day) for r in rows if r["h"]}
    eves = {(r["ts"].month, r["ts"].day) for r in rows if r["e"]}
    assert holidays == {
        (1, 1), (1, 18), (2, 15), (5, 30), (7, 4), (9, 5), (10, 10), (11, 11), (11, 24), (12, 25),
    }
    assert eves == {
        (12, 31), (1, 17), (2, 14), (5, 29), (7, 3), (9, 4), (10, 9), (11, 10), (11, 23), (12, 24),
    }


def test_iso_week_and_weekday(spark):
    row = spark.createDataFrame([(dt.datetime(2016, 1, 1),)], STAMPS).select(F.weekofyear("ts"), F.weekday("ts")).first()
    assert tuple(row) == (53, 4)


def test_day_month_date_takes_the_given_year(spark):
    assert one(spark, calendar.day_month_date(F.lit("29-2-1999"), 2016)) == dt.date(2016, 2, 29)


def test_text_functions(spark):
    steps = F.lit("left|slight left|none|straight|sharp right")
    assert [one(spark, text.count_word(steps, w)) for w in text.STEP_WORDS] == [2, 1, 1, 1]
    assert many(spark, [("T",), ("0.5",), (None,), ("x",)], "c string", text.measured_or_trace(F.col("c"))) == [-1.0, 0.5, None, None]
    assert many(spark, [("Y",), ("N",), (None,)], "c string", text.flag_from_letter(F.col("c"))) == [1, 0, 0]


def test_numeric_id_and_hash_bucket(spark):
    assert one(spark, numeric.numeric_id(F.lit("id2875421"))) == 2875421
    buckets = spark.range(5000).select(numeric.hash_bucket(F.col("id"), 42, 5).alias("b")).groupBy("b").count().collect()
    assert sorted(r["b"] for r in buckets) == [0, 1, 2, 3, 4]
    assert all(850 < r["count"] < 1150 for r in buckets)


def test_round_half_even(spark):
    found = many(spark, [(0.5,), (1.5,), (-2.5,)], "c double", numeric.round_half_even(F.col("c"), 0))
    assert found == [0.0, 2.0, -2.0]


def test_row_numbers_are_those_of_the_whole_order(spark):
    from tripworks.operators import rows

    df = spark.range(3000).selectExpr("id", "cast(id * 7919 % 101 as int) as k", "if(id % 50 = 0, null, id % 3) as n")
    got = {r["id"]: r["no"] for r in rows.with_row_numbers(df, ["n", "k", "id"], "no").collect()}
    order = sorted(df.collect(), key=lambda r: (r["n"] is not None, r["n"] or 0, r["k"], r["id"]))
    assert got == {r["id"]: i + 1 for i, r in enumerate(order)}
    kept = sorted(r["id"] for r in rows.every_nth(df, 7, ["n", "k", "id"], start=2).collect())
    assert kept == sorted(r["id"] for r in order[2::7])
    plan = rows.with_row_numbers(df, ["id"], "no")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert rows.every_nth(df.where("id < 0"), 7, ["id"]).count() == 0
