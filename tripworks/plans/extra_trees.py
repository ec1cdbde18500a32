"""Extremely randomised regression trees: thresholds are drawn, the best of a few draws is kept."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.sql import Column, DataFrame, functions as F

from tripworks.functions.numeric import array_constant

LEAF = -1
# Nodes of all trees at one level that may be open: bounds what an aggregate sends to the driver.
MOST_OPEN = 1 << 18


@dataclass
class Forest:
    """Trees as heaps, node 1 on top: per tree and node the feature (or LEAF), threshold and mean label."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, trees: int, depth: int) -> Forest:
        shape = (trees, 2 << depth)
        return cls(np.full(shape, LEAF), np.zeros(shape), np.zeros(shape))

    def node(self, x: Column, levels: int) -> Column:
        """Array with the node of a row in each tree, at most so many levels down."""
        width = self.feature.shape[1]
        feature, threshold = array_constant(self.feature.ravel().tolist(), "int"), array_constant(self.threshold.ravel().tolist(), "double")

        def down(tree: Column) -> Column:
            def step(node: Column, _: Column) -> Column:
                at = tree * width + node + 1
                right = F.element_at(x, F.element_at(feature, at) + 1) > F.element_at(threshold, at)
                return F.when(F.element_at(feature, at) == LEAF, node).otherwise(2 * node + right.cast("int"))

            return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(1), step)

        each = F.sequence(F.lit(0), F.lit(len(self.feature) - 1))
        return F.transform(each, down if levels else lambda tree: F.lit(1))

    def predict(self, x: Column, depth: int) -> Column:
        """Mean over the trees of the value of a row's leaf."""
        width, trees = self.value.shape[1], len(self.value)
        value = array_constant(self.value.ravel().tolist(), "double")
        leaves = F.transform(self.node(x, depth), lambda node, tree: F.element_at(value, tree * width + node + 1))
        return F.aggregate(leaves, F.lit(0.0), lambda s, v: s + v) / trees


def draws(seed: int, tree: int, node: int, low: np.ndarray, high: np.ndarray, candidates: int) -> tuple[np.ndarray, np.ndarray]:
    """Features, without repetition, that vary in a node, and a threshold for each, even between its bounds there."""
    rng = np.random.default_rng([seed, tree, node])
    varying = np.flatnonzero(high > low)
    chosen = rng.permutation(varying)[:candidates]
    return chosen, rng.uniform(low[chosen], high[chosen])


def gain(n: float, s: float, n_left: np.ndarray, s_left: np.ndarray) -> np.ndarray:
    """By how much a cut lowers the sum of squared errors."""
    n_right, s_right = n - n_left, s - s_left
    with np.errstate(divide="ignore", invalid="ignore"):
        return s_left**2 / n_left + s_right**2 / n_right - s * s / n


Counts = Callable[[list[tuple[int, int]], np.ndarray, np.ndarray, int], dict[int, tuple[int, float, np.ndarray, np.ndarray]]]


def grow(counts: Counts, low: np.ndarray, high: np.ndarray, rows: int, total: float, trees: int, depth: int, candidates: int, least: int, seed: int) -> Forest:
    """Grow all trees one level at a time; ``counts`` answers for all open nodes and candidates of a level at once.

    A node's bounds are those of the data, narrowed by the cuts above it. A node is closed if no
    candidate leaves ``least`` rows on both sides and lowers the error.
    """
    forest = Forest.empty(trees, depth)
    forest.value[:, 1] = total / rows
    open_nodes = {(t, 1): (low, high) for t in range(trees)}
    for level in range(depth):
        slots = list(open_nodes)
        if not slots or len(slots) > MOST_OPEN:
            break
        drawn = [draws(seed, t, node, *open_nodes[t, node], candidates) for t, node in slots]
        feature, threshold = np.zeros((len(slots), candidates), int), np.full((len(slots), candidates), -np.inf)
        for i, (f, x) in enumerate(drawn):
            feature[i, : len(f)], threshold[i, : len(f)] = f, x
        following = {}
        for i, (n, s, n_left, s_left) in counts(slots, feature, threshold, level, forest).items():
            tree, node = slots[i]
            fits = (n_left >= least) & (n - n_left >= least)
            gains = np.where(fits, gain(n, s, n_left, s_left), -np.inf)
            best = int(np.argmax(gains))
            if not gains[best] > 1e-12 * max(1.0, abs(s)):
                continue
            f, x = int(feature[i, best]), float(threshold[i, best])
            forest.feature[tree, node], forest.threshold[tree, node] = f, x
            forest.value[tree, 2 * node] = s_left[best] / n_left[best]
            forest.value[tree, 2 * node + 1] = (s - s_left[best]) / (n - n_left[best])
            below, above = (b.copy() for b in open_nodes[tree, node])
            below_high, above_low = above.copy(), below.copy()
            below_high[f], above_low[f] = x, x
            following[tree, 2 * node], following[tree, 2 * node + 1] = (below, below_high), (above_low, above)
        open_nodes = following
    return forest


class ExtraTrees(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    """Mean of ``numTrees`` trees on all rows. Rows without label or with missing features teach nothing.

    Each level of all trees is one scan: rows find their node in each tree by the cuts made so far, and
    one aggregate over (tree, node) counts and sums every candidate's left side, combined before the
    shuffle. What reaches the driver are a few numbers per open node, whatever the number of rows.
    """

    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of cuts", TypeConverters.toInt)
    candidates = Param(Params._dummy(), "candidates", "cuts drawn per node, each of another feature", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least rows of a child", TypeConverters.toInt)

    def __init__(self, trees: int = 20, depth: int = 8, candidates: int = 5, least: int = 1, seed: int = 42):
        super().__init__()
        self._set(numTrees=trees, maxDepth=depth, candidates=candidates, minInstancesPerNode=least, seed=seed)

    def _fit(self, dataset: DataFrame) -> ExtraTreesModel:
        trees, depth, k = (self.getOrDefault(p) for p in (self.numTrees, self.maxDepth, self.candidates))
        x = vector_to_array(F.col(self.getFeaturesCol()))
        data = dataset.select(F.col(self.getLabelCol()).cast("double").alias("y"), x.alias("x"))
        data = data.where(F.col("y").isNotNull() & F.col("x").isNotNull())
        width = (data.agg(F.max(F.size("x"))).first()[0]) or 0
        ends = [f(F.col("x")[i]).alias(f"{n}{i}") for i in range(width) for n, f in (("low", F.min), ("high", F.max))]
        row = data.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), *ends).first()
        if not row["n"]:
            return self._copyValues(ExtraTreesModel(Forest.empty(1, 0), 0))
        low, high = (np.array([row[f"{n}{i}"] for i in range(width)], dtype=float) for n in ("low", "high"))

        def counts(slots, feature, threshold, level, forest):
            first = 1 << level
            slot_of = np.full((trees, first), -1)
            for i, (tree, node) in enumerate(slots):
                slot_of[tree, node - first] = i
            table = array_constant(slot_of.ravel().tolist(), "int")
            features, thresholds = array_constant(feature.ravel().tolist(), "int"), array_constant(threshold.ravel().tolist(), "double")
            # a node that was closed on a level above is less than the first of this one
            placed = data.select("y", "x", F.posexplode(forest.node(F.col("x"), level)).alias("tree", "node")).where(F.col("node") >= first)
            placed = placed.withColumn("slot", F.element_at(table, F.col("tree") * first + F.col("node") - first + 1)).where("slot >= 0")

            def left(j: int) -> Column:
                at = F.col("slot") * k + j + 1
                return F.element_at(F.col("x"), F.element_at(features, at) + 1) <= F.element_at(thresholds, at)

            sums = [F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")]
            for j in range(k):
                sums += [F.count_if(left(j)).alias(f"n{j}"), F.sum(F.when(left(j), F.col("y")).otherwise(0.0)).alias(f"s{j}")]
            return {
                r["slot"]: (r["n"], r["s"], *(np.array([r[f"{c}{j}"] for j in range(k)], dtype=float) for c in ("n", "s")))
                for r in placed.groupBy("slot").agg(*sums).collect()
            }

        least, seed = self.getOrDefault(self.minInstancesPerNode), self.getOrDefault(self.seed)
        forest = grow(counts, low, high, row["n"], row["s"], trees, depth, k, least, seed)
        return self._copyValues(ExtraTreesModel(forest, depth))


class ExtraTreesModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    numTrees, maxDepth = ExtraTrees.numTrees, ExtraTrees.maxDepth
    candidates, minInstancesPerNode = ExtraTrees.candidates, ExtraTrees.minInstancesPerNode

    def __init__(self, forest: Forest, depth: int):
        super().__init__()
        self.forest, self.depth = forest, depth

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(F.col(self.getFeaturesCol()))
        return dataset.withColumn(self.getPredictionCol(), self.forest.predict(x, self.depth))
