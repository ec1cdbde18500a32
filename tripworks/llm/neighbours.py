"""Nearest neighbours by inner product: a forest of random-projection trees and exact reranking."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tripworks.functions.numeric import array_constant
from tripworks.sources.scratch import materialise

TREES = 8
# Rows of a leaf, about, as long as the sample can tell that many leaves apart.
LEAF = 512
# The trees are fitted on about this many rows, by hash of their id; each leaf must hold SEEN of them.
# All rows are indexed.
SAMPLE = 32_768
SEEN = 16
# A query's queue is emptied until the leaves taken hold this many rows per indexed row, over all trees.
# On vectors with next to no structure, near ones are hardly nearer than others and this must be
# large: at 1.5, about 8 of 10 rows are compared. On clustered vectors a few hundredths do.
SHARE = 1.5
# Leaves taken first. What they find is the score that rows of later leaves must reach.
FIRST = 8
# Rows and queries of a leaf that meet in one task; fuller leaves are cut into parts of this size.
PART = 20_000
SEED = 20


@dataclass
class Forest:
    """Direction per tree and level, threshold per inner node; nodes numbered as in a heap, from 1."""

    directions: np.ndarray  # dimensions x (trees * depth)
    thresholds: np.ndarray  # trees x 2^depth
    depth: int

    def leaves(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point in each tree."""
        trees = len(self.thresholds)
        place = np.ones((len(points), trees), dtype=np.int64)
        sides = points @ self.directions
        for level in range(self.depth):
            for tree in range(trees):
                here = place[:, tree]
                place[:, tree] = 2 * here + (sides[:, tree * self.depth + level] > self.thresholds[tree, here])
        return place - (1 << self.depth)

    def probes(self, point: np.ndarray, sizes: np.ndarray, budget: float) -> list[tuple[int, int]]:
        """Leaves (tree, leaf) for a query, nearest first, from one queue over all trees."""
        sides = point @ self.directions
        queue = [(0.0, tree, 0, 1) for tree in range(len(self.thresholds))]
        taken, rows = [], 0
        while queue and rows < budget:
            away, tree, level, node = heapq.heappop(queue)
            while level < self.depth:
                margin = sides[tree * self.depth + level] - self.thresholds[tree, node]
                heapq.heappush(queue, (away + margin * margin, tree, level + 1, 2 * node + (margin <= 0)))
                node, level = 2 * node + (margin > 0), level + 1
            leaf = node - (1 << self.depth)
            taken.append((tree, leaf))
            rows += int(sizes[tree, leaf])
        return taken


def fit(sample: np.ndarray, rows: int, trees: int, leaf: int) -> Forest:
    """Random directions; each node is cut at the median of what the sample has there."""
    wanted = max(1, min(rows / leaf, len(sample) / SEEN))
    depth = int(np.ceil(np.log2(wanted)))
    rng = np.random.default_rng(SEED)
    directions = rng.standard_normal((sample.shape[1], trees * depth))
    directions /= np.maximum(np.linalg.norm(directions, axis=0), 1e-300)
    thresholds = np.zeros((trees, 1 << depth))
    sides = sample @ directions
    for tree in range(trees):
        place = np.ones(len(sample), dtype=np.int64)
        for level in range(depth):
            side = sides[:, tree * depth + level]
            order = np.argsort(place, kind="stable")
            cuts = np.flatnonzero(np.diff(place[order])) + 1
            for group in np.split(order, cuts):
                thresholds[tree, place[group[0]]] = np.median(side[group])
            place = 2 * place + (side > thresholds[tree, place])
    return Forest(directions, thresholds, depth)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    flat = column.flatten() if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, size)


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """One more coordinate that makes all rows equally long: then the nearest has the largest product."""
    rest = np.sqrt(np.maximum(longest * longest - (vectors * vectors).sum(axis=1), 0))
    return np.column_stack([vectors, rest])


def _bits(probes: list[tuple[int, int]], trees: int, leaves: int) -> bytes:
    mask = np.zeros((trees, leaves), dtype=bool)
    for tree, leaf in probes:
        mask[tree, leaf] = True
    return np.packbits(mask).tobytes()


def usable(rows: DataFrame, row_id: str, vector: str) -> DataFrame:
    """(id, v) of rows that take part: an id, finite components, not all zero, as many as most rows have."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    good = rows.select(F.col(row_id).cast("bigint").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & finite & some)
    width = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.where(F.size("v") == (width["n"] if width else 0))


def _merged(rows: DataFrame, k: int) -> DataFrame:
    """One row (node, v, ids) per distinct vector, with its k + 1 least ids; node is the least.

    Of more equal vectors, the others can be among nobody's k nearest: k + 1 are as near and have
    smaller ids, and only one of those can be the query itself. The limit applies before the shuffle.
    """
    place = F.dense_rank().over(W.partitionBy("v").orderBy("id"))
    least = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    merged = least.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    return merged.select(F.element_at("ids", 1).alias("node"), "v", "ids")


def _search(index: DataFrame, queries: DataFrame, shape: tuple[int, int, int], k: int) -> DataFrame:
    """(query, node, score): per query and part of a leaf, the k + 1 best rows not met in an earlier leaf."""
    size, trees, leaves = shape

    def run(key: tuple, table: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        kind = table.column("query").is_valid().to_numpy()
        rows, asks = table.filter(pa.array(~kind)), table.filter(pa.array(kind))
        out: list[tuple] = []
        if len(rows) and len(asks):
            points = _matrix(rows.column("v"), size)
            at = _matrix(rows.column("leaves"), trees).astype(np.int64)
            nodes = rows.column("node").to_numpy()
            limits = asks.column("least").to_numpy(zero_copy_only=False)
            names = asks.column("query").to_numpy()
            masks = [np.frombuffer(b"".join(asks.column(c).to_pylist()), dtype=np.uint8).reshape(len(asks), -1) for c in ("before", "now")]
            vectors = _matrix(asks.column("v"), size)
            for start in range(0, len(asks), 512):
                part = slice(start, start + 512)
                near = vectors[part] @ points.T
                # leaves taken, unpacked for these queries only
                before, now = (np.unpackbits(m[part], axis=1)[:, : trees * leaves].reshape(-1, trees, leaves).view(bool) for m in masks)
                for other in range(trees):
                    met = before[:, other][:, at[:, other]]
                    if other < tree:
                        met |= now[:, other][:, at[:, other]]
                    near[met] = -np.inf
                slack = 1e-9 * max(1.0, float(np.abs(near[np.isfinite(near)]).max(initial=0.0)))
                low = limits[part]
                if near.shape[1] > k + 1:
                    low = np.maximum(low, np.partition(near, -k - 1, axis=1)[:, -k - 1])
                who, which = np.nonzero((near >= (low - slack)[:, None]) & np.isfinite(near))
                # once more pair by pair: the score then does not depend on what else was in the part
                score = (vectors[part][who] * points[which]).sum(axis=1)
                out.append((names[part][who], nodes[which], score))
        found = [np.concatenate(c) if out else [] for c in (zip(*out, strict=True) if out else ((), (), ()))]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(found, kinds, strict=True)], names=["query", "node", "score"])

    empty = {c: F.lit(None).cast(t) for c, t in (("query", "bigint"), ("least", "double"), ("before", "binary"), ("now", "binary"))}
    left = index.withColumns(empty)
    right = queries.withColumns({"node": F.lit(None).cast("bigint"), "leaves": F.lit(None).cast("array<int>")})
    both = left.unionByName(right)
    return both.groupBy("tree", "leaf", "rpart", "qpart").applyInArrow(run, "query bigint, node bigint, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.desc("score"), "node")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)


def nearest(
    rows: DataFrame,
    row_id: str,
    vector: str,
    queries: DataFrame,
    k: int = 20,
    trees: int = TREES,
    leaf: int = LEAF,
    share: float = SHARE,
) -> DataFrame:
    """(query_id, rank, row_id, score): the ``k`` rows found nearest to each row of ``queries``, itself apart.

    ``queries`` are rows with the same two columns, by their id. Rows and queries without id, null,
    zero, with null or non-finite components, or of another length than most rows, take no part. Rows
    equal in id and vector are one; an id with several vectors stands for each of them. Score is the
    inner product in doubles; ties go to the smaller id. Fewer than ``k`` candidates: all of them.
    """
    spark = rows.sparkSession
    good = usable(rows, row_id, vector)
    index = materialise(_merged(good, k), "vectors")
    stats = index.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))), F.max(F.size("v"))).first()
    total, longest, size = stats[0], stats[1] or 0.0, stats[2] or 1
    keep = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(1, total)) * (1 << 30))
    sample = index.where(keep).orderBy("node").select("v").collect()
    points = np.array([r["v"] for r in sample], dtype=float).reshape(-1, size)
    fitted = fit(_lifted(points, longest), total, trees, leaf)
    leaves = 1 << fitted.depth
    forest = spark.sparkContext.broadcast((fitted.directions, fitted.thresholds, fitted.depth))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = Forest(*forest.value).leaves(_lifted(_matrix(batch.column(1), size), longest)).astype(np.int32)
            placed = pa.ListArray.from_arrays(np.arange(0, at.size + 1, trees, dtype=np.int32), pa.array(at.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), placed], names=["node", "v", "leaves"])

    placed = materialise(index.select("node", "v").mapInArrow(place, "node bigint, v array<double>, leaves array<int>"), "placed")
    spread = placed.select("node", F.posexplode("leaves").alias("tree", "leaf"))
    sizes = np.zeros((trees, leaves), dtype=np.int64)
    for r in spread.groupBy("tree", "leaf").count().collect():  # at most trees x leaves rows
        sizes[r["tree"], r["leaf"]] = r["count"]
    sizes = spark.sparkContext.broadcast(sizes)

    asked = usable_like(queries, row_id, vector, size).join(index.select("node", "v"), "v").select("id", "node")
    asked = materialise(asked, "queries")
    points = index.join(asked.select("node").distinct(), "node", "left_semi").select("node", "v")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query", "v", "first", "later", "first_leaves", "later_leaves"]
        for batch in batches:
            vectors = _matrix(batch.column(1), size)
            columns: list[list] = [[], [], [], []]
            for point in np.column_stack([vectors, np.zeros(len(vectors))]):
                taken = Forest(*forest.value).probes(point, sizes.value, share * total)
                for column, some in zip(columns, (taken[:FIRST], taken[FIRST:]), strict=False):
                    column.append(_bits(some, trees, leaves))
                for column, some in zip(columns[2:], (taken[:FIRST], taken[FIRST:]), strict=True):
                    column.append([t * leaves + x for t, x in some])
            kinds = (pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=names)

    schema = "query bigint, v array<double>, first binary, later binary, first_leaves array<int>, later_leaves array<int>"
    probed = materialise(points.mapInArrow(probe, schema), "probes")

    def phase(column: str, before: str, now: str, floor: DataFrame | None) -> DataFrame:
        asks = probed.select("query", "v", F.col(before).alias("before") if before else F.lit(bytes(-(-trees * leaves // 8))).alias("before"), F.col(now).alias("now"), F.explode(column).alias("at"))
        counts = asks.groupBy("at").count().collect()  # at most trees x leaves rows
        cuts = [0] * (trees * leaves)
        for r in counts:
            cuts[r["at"]] = -(-r["count"] // PART)
        qparts, rparts = array_constant(cuts, "bigint"), array_constant([int(-(-n // PART) or 1) for n in sizes.value.reshape(-1)], "bigint")
        rows = placed.select("node", "v", "leaves", F.posexplode("leaves").alias("tree", "leaf"))
        at = F.col("tree") * leaves + F.col("leaf")
        rows = rows.withColumn("rpart", F.pmod(F.xxhash64("node"), F.element_at(rparts, at + 1)))
        asked_parts = F.element_at(qparts, at + 1)
        rows = rows.where(asked_parts > 0).withColumn("qpart", F.explode(F.sequence(F.lit(0).cast("bigint"), asked_parts - 1)))
        asks = asks.withColumn("qpart", F.pmod(F.xxhash64("query"), F.element_at(qparts, F.col("at") + 1)))
        asks = asks.withColumn("rpart", F.explode(F.sequence(F.lit(0).cast("bigint"), F.element_at(rparts, F.col("at") + 1).cast("bigint") - 1)))
        asks = asks.withColumns({"tree": (F.col("at") / leaves).cast("int"), "leaf": F.col("at") % leaves}).drop("at")
        if floor is None:
            asks = asks.withColumn("least", F.lit(float("-inf")))
        else:
            asks = asks.join(floor, "query", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
        return _search(rows, asks, (size, trees, leaves), k)

    near = materialise(_best(phase("first_leaves", "", "first", None), k), "near")
    floor = near.where(F.col("rank") == k + 1).select("query", F.col("score").alias("least"))
    rest = phase("later_leaves", "first", "later", materialise(floor, "floor"))
    best = materialise(_best(near.drop("rank").union(rest), k).drop("rank"), "best")
    named = best.join(index.select("node", "ids"), "node").select(F.col("query").alias("of"), "score", F.explode("ids").alias("found"))
    met = asked.join(named, asked["node"] == named["of"]).where(F.col("id") != F.col("found"))
    order = W.partitionBy("id").orderBy(F.desc("score"), "found")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("query_id"), "rank", F.col("found").alias(row_id), "score")


def usable_like(rows: DataFrame, row_id: str, vector: str, size: int) -> DataFrame:
    """Queries that take part: rows of the index's length."""
    v = F.col(vector).cast("array<double>")
    return rows.select(F.col(row_id).cast("bigint").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & (F.size("v") == size)).distinct()
