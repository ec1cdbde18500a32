"""Recall against brute force, exact scores, ties and copies."""

import numpy as np
import pytest

from tripworks.llm import neighbours
from tripworks.llm.frames import prepare, read

SCHEMA = "vec_id bigint, embedding array<double>, rank string, score string, id int"


def brute(vectors, query, k=20):
    scores = {i: float(np.dot(v, vectors[query])) for i, v in vectors.items() if i != query}
    return sorted(scores, key=lambda i: (-scores[i], i))[:k]


def by_query(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return found


@pytest.mark.parametrize("leaf", [128, neighbours.LEAF])
def test_recall_on_the_given_vectors(spark, leaf):
    """With small leaves, so that the trees have to choose, and as registered: 9 of 10 are found."""
    prepare(spark)
    rows = read(spark, "/root/testdata/sf0.1", "embeddings")
    found = by_query(neighbours.nearest(rows, "vec_id", "embedding", rows.where("vec_id % 20 = 0"), leaf=leaf))
    vectors = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in rows.collect()}
    queries = [i for i in vectors if i % 20 == 0]
    assert sorted(found) == sorted(queries)
    hits = 0
    for q in queries:
        assert [s for _, s in found[q]] == pytest.approx([float(np.dot(vectors[i], vectors[q])) for i, _ in found[q]], abs=1e-12)
        hits += len({i for i, _ in found[q]} & set(brute(vectors, q)))
    assert hits >= 0.9 * 20 * len(queries)


def test_forest_puts_each_point_in_one_leaf_and_probes_the_own_first():
    rng = np.random.default_rng(1)
    points = rng.standard_normal((2000, 8))
    forest = neighbours.fit(points, 2000, 3, 100)
    leaves = forest.leaves(points)
    sizes = np.stack([np.bincount(leaves[:, t], minlength=1 << forest.depth) for t in range(3)])
    assert forest.depth == 5 and sizes.sum() == 6000 and sizes.max() <= 70
    for k in range(20):
        probes = forest.probes(points[k], sizes, 1e9)
        assert set(probes[:3]) == {(t, leaves[k, t]) for t in range(3)} and len(set(probes)) == len(probes) == 96
        assert sum(sizes[t, leaf] for t, leaf in forest.probes(points[k], sizes, 300)) >= 300


def test_full_share_is_exact_with_copies_ties_and_parts(spark, monkeypatch):
    """All leaves taken: the result is that of brute force, whatever repeats and however leaves are cut."""
    prepare(spark)
    monkeypatch.setattr(neighbours, "PART", 37)
    rng = np.random.default_rng(5)
    base = rng.integers(-3, 4, (60, 6)).astype(float)
    base[base.any(axis=1) == 0] = 1
    vectors = {i: base[rng.integers(60)] if i % 3 else base[0] for i in range(500)}
    rows = [(i, [float(x) for x in v], None, "s", 1) for i, v in vectors.items()]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = by_query(neighbours.nearest(df, "vec_id", "embedding", df.where("vec_id % 10 = 0"), leaf=20, share=1e9))
    for q in range(0, 500, 10):
        assert [i for i, _ in found[q]] == brute(vectors, q)


def test_odd_vectors(spark):
    prepare(spark)
    nan, inf = float("nan"), float("inf")
    rows = [
        (20, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (None, [1.0, 1.0]), (3, None), (40, None), (60, [0.0, 0.0]),
        (4, [nan, 1.0]), (80, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0]), (100, []), (7, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, "x", "y", 0) for r in rows], SCHEMA)
    found = by_query(neighbours.nearest(df, "vec_id", "embedding", df.where("vec_id % 20 = 0")))
    assert found == {20: [(1, 1.0), (2, 0.5), (7, -1.0)]}
    empty = spark.createDataFrame([], SCHEMA)
    assert neighbours.nearest(empty, "vec_id", "embedding", empty).count() == 0
    assert neighbours.nearest(df, "vec_id", "embedding", empty).count() == 0
