"""Regression on log duration: cross-validated rounds, out-of-fold predictions and sweeps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tripworks.functions.numeric import from_log_target, log_target, numeric_id
from tripworks.operators.rows import assign_folds
from tripworks.sources.schema import MODEL_DROPPED, TEST, TRAIN
from tripworks.sources.scratch import materialise

NOT_FEATURES = {"id", "split", "trip_duration", "fold", "label", *MODEL_DROPPED}


def model_frame(
    df: DataFrame,
    features: Sequence[str] | None = None,
    use_id: bool = False,
    missing: float = 0.0,
    folds: int = 5,
    seed: int = 42,
) -> DataFrame:
    """``id, split, fold, label, features`` for the learners: all numeric columns in one vector.

    Missing numbers become ``missing``, the label is the log of the duration (NULL for test), and
    the number in the id joins the features only on request.
    """
    names = list(features) if features else [
        f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in NOT_FEATURES
    ]
    columns = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(missing)).alias(f"f{i}") for i, c in enumerate(names)]
    if use_id:
        columns.append(numeric_id(F.col("id")).cast("double").alias(f"f{len(names)}"))
    inputs = [f"f{i}" for i in range(len(columns))]
    flat = df.select("id", "split", log_target(F.col("trip_duration")).alias("label"), *columns)
    vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(flat)
    return assign_folds(vectors.select("id", "split", "label", "features"), folds, seed)


def boosted_trees(
    rounds: int = 100, depth: int = 8, step: float = 0.1, subsample: float = 0.93, seed: int = 42, **settings
) -> GBTRegressor:
    return GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=subsample, seed=seed, **settings)


def bagged_trees(trees: int = 500, depth: int = 8, seed: int = 42, **settings) -> RandomForestRegressor:
    return RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=seed, **settings)


# --- error measures -------------------------------------------------------------------------------


def squared_error(label: Column, prediction: Column) -> Column:
    return (label - prediction) * (label - prediction)


def squared_log_error(log_label: Column, log_prediction: Column) -> Column:
    """Squared difference of log(1+x) of durations, from their logs; predictions below 0 count as 0."""
    predicted = F.log1p(F.exp(F.greatest(log_prediction, F.lit(0.0))))
    return squared_error(F.log1p(F.exp(log_label)), predicted)


def error_metrics(predictions: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()):
    """MSE, RMSE and RMSLE of predictions on the log scale, per group if asked."""
    mse = F.avg(squared_error(F.col(label), F.col(prediction)))
    rmsle = F.sqrt(F.avg(squared_log_error(F.col(label), F.col(prediction))))
    columns = [mse.alias("mse"), F.sqrt(mse).alias("rmse"), rmsle.alias("rmsle")]
    return predictions.groupBy(*by).agg(*columns)


def fold_means(per_fold: DataFrame) -> DataFrame:
    return per_fold.agg(*(F.avg(c).alias(c) for c in ("mse", "rmse", "rmsle")))


# What a sweep may look at: root mean squared error on the log scale, or of log(1 + duration).
METRICS: dict[str, Callable[[Column, Column], Column]] = {"rmse": squared_error, "rmsle": squared_log_error}


# --- a learner that SQL can state -----------------------------------------------------------------


class GroupMean(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Mean label by the value of the first feature, drawn to the overall mean by ``weight`` rows of it.

    A baseline for the boosted trees, and the learner whose folds and sweeps are checked against SQL.
    The first feature must be a category of at most ``MOST_GROUPS`` values.
    """

    MOST_GROUPS = 10_000
    weight = Param(Params._dummy(), "weight", "rows of the overall mean added to each group", TypeConverters.toFloat)

    def __init__(self, weight: float = 0.0):
        super().__init__()
        self._set(weight=weight)

    def _fit(self, dataset: DataFrame) -> GroupMeanModel:
        label, group = F.col(self.getLabelCol()), vector_to_array(F.col(self.getFeaturesCol()))[0]
        sums = dataset.groupBy(group.alias("g")).agg(F.sum(label).alias("s"), F.count(label).alias("n"))
        groups = sums.where("n > 0").limit(self.MOST_GROUPS + 1).collect()
        if len(groups) > self.MOST_GROUPS:
            raise ValueError("the first feature has too many values for a category")
        total, rows = sum(r["s"] for r in groups), sum(r["n"] for r in groups)
        overall, weight = total / rows if rows else 0.0, self.getOrDefault(self.weight)
        means = {r["g"]: (r["s"] + weight * overall) / (r["n"] + weight) for r in groups}
        return self._copyValues(GroupMeanModel(means, overall))


class GroupMeanModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    weight = GroupMean.weight

    def __init__(self, means: Mapping[float, float], overall: float):
        super().__init__()
        self.means, self.overall = means, overall

    def _transform(self, dataset: DataFrame) -> DataFrame:
        target = self.getPredictionCol()
        rest = [c for c in dataset.columns if c != target]
        table = [(float(g), float(m)) for g, m in self.means.items()]  # MOST_GROUPS rows at most
        means = dataset.sparkSession.createDataFrame(table, "_group double, _mean double")
        keyed = dataset.withColumn("_key", vector_to_array(F.col(self.getFeaturesCol()))[0])
        met = keyed.join(F.broadcast(means), F.col("_key") == F.col("_group"), "left")
        return met.select(*rest, F.coalesce("_mean", F.lit(self.overall)).alias(target))


# --- fitting --------------------------------------------------------------------------------------


def _for_each_fold(spark: SparkSession, folds: int, work: Callable[[int], Any], parallelism: int) -> list[Any]:
    """Run the folds' jobs side by side: one small fit cannot keep a cluster busy."""
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, folds))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), range(folds)))


# Rows of a part: fewer cost less than the histograms of its nodes, more are too much for one task.
LEAST_PART, MOST_PART = 40_000, 1_000_000


def fit_shape(rows: int, cores: int) -> tuple[int, int]:
    """In how many parts so many rows are fitted, and how many such fits run side by side.

    Every part sends a histogram per node, feature and level: there are as many as cores if each
    holds ``LEAST_PART`` rows, and more only beyond ``MOST_PART``. One fit more than fills the cores
    runs, as each waits for the driver at times, but not if rows of ``MOST_PART`` per core are
    exceeded: fits keep their rows in memory.
    """
    parts = max(1, min(cores, rows // LEAST_PART), -(-rows // MOST_PART))
    return parts, max(1, min(cores // parts + 1, cores * MOST_PART // max(rows, 1)))


def best_rounds(
    train: DataFrame, learner: GBTRegressor, folds: int, parallelism: int = 2, tolerance: float = 0.001
) -> int:
    """Number of boosting rounds with the lowest mean validation error over the folds.

    Each fold stops adding trees once they improve its held-out error by less than ``tolerance`` of
    it; from there on its error counts as unchanged.
    """
    early = {learner.validationIndicatorCol: "_held_out", learner.validationTol: tolerance}

    def errors(i: int) -> list[float]:
        marked = train.withColumn("_held_out", F.col("fold") == i)
        model = learner.copy(early).fit(marked)
        return model.evaluateEachIteration(marked.where("_held_out"), "squared")

    per_fold = _for_each_fold(train.sparkSession, folds, errors, parallelism)
    longest = max(map(len, per_fold))
    means = [sum(e[min(i, len(e) - 1)] for e in per_fold) / folds for i in range(longest)]
    return min(range(longest), key=means.__getitem__) + 1


def boosted_predictions(
    df: DataFrame, learner: GBTRegressor, folds: int = 3, parallelism: int = 2, **frame_settings
) -> DataFrame:
    """Choose the rounds by cross-validation, refit on all training rows and predict the test rows."""
    frame = materialise(model_frame(df, folds=folds, **frame_settings), "model-frame")
    train, test = frame.where(F.col("split") == TRAIN), frame.where(F.col("split") == TEST)
    final = learner.copy({learner.maxIter: best_rounds(train, learner, folds, parallelism)}).fit(train)
    return final.transform(test).select("id", from_log_target(F.col("prediction")).alias("trip_duration"))


@dataclass(frozen=True)
class OutOfFold:
    """Predictions of an ensemble of fold models."""

    train: DataFrame  # id, fold, label, prediction, trip_duration: each row by the model that never saw it
    test: DataFrame  # id, trip_duration: mean of the fold models on the log scale
    per_fold: DataFrame  # id, fold, trip_duration: test rows by every fold model
    models: list[Any]

    def scores(self) -> DataFrame:
        return error_metrics(self.train, by=["fold"])


def out_of_fold(
    df: DataFrame, learner: Estimator, folds: int = 5, seed: int = 42, parallelism: int = 2, pack: bool = False, **frame_settings
) -> OutOfFold:
    """k models, each fitted without its fold.

    Predictions travel with the trip id, so no row order matters. The k predictions of a test row
    are columns of one scan, not k frames to be joined. ``pack``: fits in few large parts, as many
    side by side as ``fit_shape`` says, for learners of many rounds; those that draw rows by part then
    draw others.
    """
    frame = materialise(model_frame(df, folds=folds, seed=seed, **frame_settings), "model-frame")
    train, test = frame.where(F.col("split") == TRAIN), frame.where(F.col("split") == TEST)

    parts = None
    if pack:
        parts, parallelism = fit_shape(train.count() * (folds - 1) // folds, df.sparkSession.sparkContext.defaultParallelism)

    def fit_without(i: int):
        rest = train.where(F.col("fold") != i)
        return learner.fit(rest.coalesce(parts) if parts else rest)

    models = _for_each_fold(df.sparkSession, folds, fit_without, parallelism)

    held_out = None
    for i, model in enumerate(models):
        part = model.transform(train.where(F.col("fold") == i)).select("id", "fold", "label", "prediction")
        held_out = part if held_out is None else held_out.unionByName(part)
    held_out = held_out.withColumn("trip_duration", from_log_target(F.col("prediction")))

    scored = test.select("id", "features")
    for i, model in enumerate(models):
        scored = model.transform(scored, {model.predictionCol: f"p{i}"})
    logs = [F.col(f"p{i}") for i in range(folds)]
    mean_log = sum(logs[1:], logs[0]) / folds
    each = F.array(*(F.struct(F.lit(i).alias("fold"), from_log_target(p).alias("trip_duration")) for i, p in enumerate(logs)))
    return OutOfFold(
        train=held_out,
        test=scored.select("id", from_log_target(mean_log).alias("trip_duration")),
        per_fold=scored.select("id", F.inline(each)),
        models=models,
    )


@dataclass(frozen=True)
class Tuned:
    parameter: str
    best: Any
    errors: list[tuple[Any, float]]


def tune_parameter(
    train: DataFrame,
    learner: Estimator,
    parameter: str,
    values: Sequence[Any],
    folds: int = 3,
    parallelism: int = 2,
    metric: str = "rmse",
) -> tuple[Estimator, Tuned]:
    """Cross-validate one parameter with the others fixed; the learner returned holds the best value.

    The error of a value is the mean over the folds of the error on the fold left out; of equally
    good values the first is taken. Only the fits that are scored are made.
    """
    param, error = learner.getParam(parameter), METRICS[metric]

    def score(task: int) -> float:
        value, fold = values[task // folds], task % folds
        model = learner.copy({param: value}).fit(train.where(F.col("fold") != fold))
        scored = model.transform(train.where(F.col("fold") == fold))
        return scored.agg(F.sqrt(F.avg(error(F.col("label"), F.col("prediction"))))).first()[0]

    scores = _for_each_fold(train.sparkSession, len(values) * folds, score, parallelism)
    errors = [sum(scores[i * folds : (i + 1) * folds]) / folds for i in range(len(values))]
    best = values[min(range(len(errors)), key=errors.__getitem__)]
    return learner.copy({param: best}), Tuned(parameter, best, list(zip(values, errors)))


def sweep(
    df: DataFrame,
    learner: Estimator,
    grid: Mapping[str, Sequence[Any]],
    folds: int = 3,
    parallelism: int = 2,
    metric: str = "rmse",
    **frame_settings,
) -> tuple[Estimator, DataFrame]:
    """Tune the parameters one after another. Returns the tuned learner and the table of errors, values as text."""
    frame = materialise(model_frame(df, folds=folds, **frame_settings), "model-frame")
    train = frame.where(F.col("split") == TRAIN)
    report = []
    for parameter, values in grid.items():
        learner, tuned = tune_parameter(train, learner, parameter, values, folds, parallelism, metric)
        report += [(parameter, str(v), e, v == tuned.best) for v, e in tuned.errors]
    table = df.sparkSession.createDataFrame(report, "parameter string, value string, error double, best boolean")
    return learner, table
