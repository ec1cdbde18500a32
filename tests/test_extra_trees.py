"""Randomised trees against the same trees grown row by row."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from tripworks.plans import extra_trees, modelling
from tripworks.plans.extra_trees import LEAF, ExtraTrees


def rows_and_frame(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 4, n), rng.uniform(0, 100, n), np.full(n, 7.0)])
    y = 3 * (x[:, 0] > 0.2) + x[:, 1] + 0.01 * x[:, 2] + 0.1 * rng.normal(size=n)
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id int, a double, b double, c double, d double, label double")
    return x, y, VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df).select("id", "label", "features")


def brute_tree(x, y, tree, depth, candidates, least, seed):
    """{node: (feature, threshold)} and leaves' values, by recursion over rows."""
    cuts, values = {}, {}

    def visit(node, own, low, high, level):
        values[node] = y[own].mean()
        if level == depth:
            return
        features, thresholds = extra_trees.draws(seed, tree, node, low, high, candidates)
        best = None
        for f, t in zip(features, thresholds):
            left = x[own, f] <= t
            n = left.sum()
            if n < least or len(left) - n < least:
                continue
            before = ((y[own] - y[own].mean()) ** 2).sum()
            after = sum(((y[own][m] - y[own][m].mean()) ** 2).sum() for m in (left, ~left))
            if best is None or before - after > best[0] + 1e-9:
                best = (before - after, f, t, left)
        if best is None or best[0] <= 1e-9:
            return
        _, f, t, left = best
        cuts[node] = (f, t)
        below, above = high.copy(), low.copy()
        below[f], above[f] = t, t
        visit(2 * node, own[left], low, below, level + 1)
        visit(2 * node + 1, own[~left], above, high, level + 1)

    visit(1, np.arange(len(y)), x.min(axis=0), x.max(axis=0), 0)
    return cuts, values


@pytest.mark.parametrize("candidates,least", [(1, 1), (2, 5), (4, 1)])
def test_trees_are_those_grown_row_by_row(spark, candidates, least):
    x, y, frame = rows_and_frame(spark)
    trees, depth, seed = 3, 5, 9
    model = ExtraTrees(trees, depth, candidates, least, seed).fit(frame)
    expected = np.zeros(len(y))
    for tree in range(trees):
        cuts, values = brute_tree(x, y, tree, depth, candidates, least, seed)
        found = {n: (int(f), t) for n, (f, t) in enumerate(zip(model.forest.feature[tree], model.forest.threshold[tree])) if f != LEAF}
        assert found == {n: (int(f), t) for n, (f, t) in cuts.items()}
        for i, row in enumerate(x):
            node = 1
            while node in cuts:
                f, t = cuts[node]
                node = 2 * node + (row[f] > t)
            expected[i] += values[node] / trees
    got = {r["id"]: r["prediction"] for r in model.transform(frame).collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx(expected.tolist())


def test_predictions_are_bounded_better_than_the_mean_and_repeat(spark):
    x, y, frame = rows_and_frame(spark)
    learner = ExtraTrees(trees=10, depth=6, seed=3)
    one, two = ([r["prediction"] for r in learner.fit(frame).transform(frame).orderBy("id").collect()] for _ in range(2))
    assert one == two and min(one) >= y.min() and max(one) <= y.max()
    assert ((y - one) ** 2).mean() < 0.3 * y.var()


def test_odd_input(spark):
    _, y, frame = rows_and_frame(spark, 30)
    none = ExtraTrees(2, 3).fit(frame.where("id < 0"))
    assert {r["prediction"] for r in none.transform(frame).collect()} == {0.0}
    one = ExtraTrees(2, 3).fit(frame.where("id = 4"))
    assert [r["prediction"] for r in one.transform(frame).collect()] == pytest.approx([y[4]] * 30)
    unlabelled = frame.selectExpr("id", "if(id < 10, null, label) as label", "features")
    model = ExtraTrees(2, 0).fit(unlabelled)
    assert [r["prediction"] for r in model.transform(frame).collect()] == pytest.approx([y[10:].mean()] * 30)


def test_folds_and_sweeps_take_it_like_any_learner(spark):
    _, _, frame = rows_and_frame(spark, 200)
    train = frame.selectExpr("*", "id % 2 as fold")
    learner, tuned = modelling.tune_parameter(train, ExtraTrees(4, 4), "maxDepth", [0, 4], folds=2)
    assert tuned.best == 4 and learner.getOrDefault(learner.maxDepth) == 4 and tuned.errors[0][1] > tuned.errors[1][1]
