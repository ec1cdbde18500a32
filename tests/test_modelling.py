"""Out-of-fold and tuning invariants with few small trees."""

import math

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tripworks.operators import features, rows
from tripworks.plans import modelling, queries
from tripworks.sources import fixtures


@pytest.fixture(scope="module")
def trips(spark):
    df = features.with_distances(fixtures.trips(spark, SMALL))
    return df.select("id", "split", "trip_duration", "vendor_id", "passenger_count", "lat_long_distance_haversine").cache()


def test_frame_holds_no_gaps_and_the_id_only_on_request(trips):
    frame = modelling.model_frame(trips)
    assert frame.where("features is null").count() == 0
    assert frame.first()["features"].size == 3
    assert modelling.model_frame(trips, use_id=True).first()["features"].size == 4
    assert frame.where("split = 'test' and label is not null").count() == 0


def test_out_of_fold(trips):
    learner = modelling.bagged_trees(trees=3, depth=3)
    result = modelling.out_of_fold(trips, learner, folds=3)
    train_rows, test_rows = (trips.where(f"split = '{s}'").count() for s in ("train", "test"))
    held_out = result.train.collect()
    assert len(held_out) == train_rows and len({r["id"] for r in held_out}) == train_rows
    # The fold of a row names the model that never saw it.
    expected = {r["id"]: r["fold"] for r in rows.assign_folds(trips, 3).collect()}
    assert all(expected[r["id"]] == r["fold"] for r in held_out)
    by_fold = {(r["id"], r["fold"]): r["trip_duration"] for r in result.per_fold.collect()}
    test = {r["id"]: r["trip_duration"] for r in result.test.collect()}
    assert len(test) == test_rows and len(by_fold) == 3 * test_rows
    for trip, seconds in list(test.items())[:50]:
        logs = [math.log(by_fold[trip, i]) for i in range(3)]
        assert seconds == pytest.approx(math.exp(sum(logs) / 3))
    assert result.scores().count() == 3


def test_held_out_predictions_come_from_the_other_folds(trips):
    learner = modelling.bagged_trees(trees=2, depth=2)
    result = modelling.out_of_fold(trips, learner, folds=2, parallelism=1)
    frame = modelling.model_frame(trips, folds=2)
    again = result.models[1].transform(frame.where("split = 'train' and fold = 1"))
    expected = {r["id"]: r["prediction"] for r in again.collect()}
    got = {r["id"]: r["prediction"] for r in result.train.where("fold = 1").collect()}
    assert got == expected


def test_boosted_rounds_and_predictions(trips):
    learner = modelling.boosted_trees(rounds=3, depth=2)
    predictions = modelling.boosted_predictions(trips, learner, folds=2).collect()
    assert len(predictions) == trips.where("split = 'test'").count()
    assert all(60 <= r["trip_duration"] <= 3660 for r in predictions)
    frame = modelling.model_frame(trips, folds=2).where("split = 'train'")
    assert 1 <= modelling.best_rounds(frame, learner, 2) <= 3


def test_sweep_keeps_the_best_value(trips):
    learner = modelling.bagged_trees(trees=2, depth=2)
    tuned, table = modelling.sweep(trips, learner, {"maxDepth": [3, 1]}, folds=2)
    errors = {r["value"]: r["error"] for r in table.collect()}
    best = min(errors, key=errors.get)
    assert str(tuned.getOrDefault("maxDepth")) == best
    assert [r["value"] for r in table.where("best").collect()] == [best]


def test_sweep_by_either_metric_and_text_parameters(trips):
    learner = modelling.bagged_trees(trees=2, depth=2)
    for metric in modelling.METRICS:
        tuned, table = modelling.sweep(trips, learner, {"featureSubsetStrategy": ["all", "onethird"]}, folds=2, metric=metric)
        assert tuned.getOrDefault("featureSubsetStrategy") == table.where("best").first()["value"]


def test_rounds_stop_early(trips):
    frame = modelling.model_frame(trips, folds=2).where("split = 'train'")
    learner = modelling.boosted_trees(rounds=12, depth=2, step=1.0)
    assert modelling.best_rounds(frame, learner, 2, tolerance=0.5) <= modelling.best_rounds(frame, learner, 2, tolerance=0.0)


def test_error_measures(spark):
    data = [(math.log(100.0), math.log(110.0)), (math.log(50.0), -3.0)]
    r = modelling.error_metrics(spark.createDataFrame(data, "label double, prediction double")).first()
    mse = sum((a - b) ** 2 for a, b in data) / 2
    logs = [(math.log1p(math.exp(max(b, 0))) - math.log1p(math.exp(a))) ** 2 for a, b in data]
    assert r["mse"] == pytest.approx(mse) and r["rmse"] == pytest.approx(math.sqrt(mse))
    assert r["rmsle"] == pytest.approx(math.sqrt(sum(logs) / 2))


def own_trips(spark, rows):
    """Trips of two kinds with one duration each, every fifth a test trip."""
    data = [(f"id{i:07d}", "test" if i % 5 == 4 else "train", None if i % 5 == 4 else 100 + 900 * (i % 2), i % 2) for i in range(rows)]
    return spark.createDataFrame(data, "id string, split string, trip_duration bigint, kind int")


def test_oof_gbt_takes_all_rounds_and_levels(spark, monkeypatch):
    taken, out_of_fold = [], modelling.out_of_fold

    def short(df, learner, **settings):
        taken.append(learner)
        return out_of_fold(df, learner.copy({learner.maxIter: 2}), **settings)

    monkeypatch.setattr(queries, "_grid_features", lambda spark, sf: own_trips(spark, 60))
    monkeypatch.setattr(modelling, "out_of_fold", short)
    result = queries.REGISTRY["oof_gbt"](spark, "").collect()
    assert sorted(r["id"] for r in result) == [f"id{i:07d}" for i in range(60)]
    whole = modelling.boosted_trees()
    assert (taken[0].getMaxIter(), taken[0].getMaxDepth()) == (whole.getMaxIter(), whole.getMaxDepth()) == (100, 8)


def test_shape_of_a_fit():
    shapes = [modelling.fit_shape(n, 8) for n in (0, 39_999, 84_000, 1_000_000, 5_040_000, 50_000_000)]
    assert shapes == [(1, 9), (1, 9), (2, 5), (8, 2), (8, 1), (50, 1)]


def test_packed_folds_use_all_rows_and_rounds(spark):
    trips = own_trips(spark, 60).repartition(6)
    result = modelling.out_of_fold(trips, modelling.boosted_trees(rounds=30, depth=2, subsample=1.0), folds=3, pack=True)
    plain = modelling.out_of_fold(trips, modelling.boosted_trees(rounds=30, depth=2, subsample=1.0), folds=3)
    assert [m.getNumTrees for m in result.models] == [30] * 3
    for kind in ("train", "test"):
        got, expected = ({r["id"]: r["trip_duration"] for r in getattr(o, kind).collect()} for o in (result, plain))
        assert got.keys() == expected.keys() and len(got) == {"train": 48, "test": 12}[kind]
        assert all(got[i] == pytest.approx(expected[i]) == pytest.approx(100 + 900 * (int(i[2:]) % 2)) for i in got)
