"""Targets and copies."""

import pytest
from llm_cases import no_documents, odd_documents
from pyspark.sql import functions as F

from tripworks.llm import mixture
from tripworks.llm.frames import prepare, ranked


def brute_targets(sizes, weights=mixture.WEIGHTS, budget=1.5, most=2.0):
    """Share, stop at the limit, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = budget * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else weight[s] * rest / open_ for s in names}
        over = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def docs_of(spark, sizes):
    rows = [(i * 100 + k, "w " * n, s) for i, (s, ns) in enumerate(sizes.items()) for k, n in enumerate(ns)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": [5, 9, 1], "b": [100, 3], "c": [40], None: [7, 7]},
        {"a": [1], "b": [1000] * 3, "c": [2, 2]},
        {"only": [3, 4, 5]},
        {"z": [0, 0], "é": [10] * 50, "A": [9] * 30, "a": [0]},
    ],
)
def test_targets_and_copies(spark, sizes):
    found = mixture.copies(docs_of(spark, sizes)).collect()
    expected = brute_targets({s: sum(ns) for s, ns in sizes.items()})
    longest = {s: max(ns) for s, ns in sizes.items()}
    for s, target in expected.items():
        own = [r for r in found if r["source"] == s]
        assert len(own) == len(sizes[s]) and all(r["target"] == pytest.approx(target) for r in own)
        assert all(0 <= r["copies"] <= 2 for r in own)
        assert abs(sum(r["copies"] * r["size"] for r in own) - target) <= 2 * longest[s] + 1e-6


def test_reruns_and_partitioning_agree(spark):
    docs = docs_of(spark, {"a": list(range(40)), "b": [5] * 60})
    first = sorted(map(tuple, mixture.copies(docs.coalesce(1)).collect()))
    assert first == sorted(map(tuple, mixture.copies(docs.repartition(7)).collect()))


def test_mix_emits_each_document_as_often_as_it_is_taken(spark):
    docs = docs_of(spark, {"a": list(range(30)), "b": [5] * 90, "c": [60] * 4})
    taken = {r["doc_id"]: r["copies"] for r in mixture.copies(docs).collect()}
    mixed = mixture.mix(docs)
    assert mixed.columns == ["doc_id", "text", "source", "copy"]
    got = {}
    for r in mixed.collect():
        got.setdefault(r["doc_id"], []).append(r["copy"])
    assert {i: sorted(c) for i, c in got.items()} == {i: list(range(1, n + 1)) for i, n in taken.items() if n}


def test_odd_documents(spark):
    prepare(spark)
    docs = odd_documents(spark)
    found = mixture.copies(docs)
    assert found.count() == docs.count()
    assert found.where("doc_id in (3, 4, 5)").agg(F.sum("size")).first()[0] == 0
    mixed = mixture.mix(docs)
    assert mixed.columns == [*(c for c in docs.columns if c != "copy"), "copy"]
    assert mixed.count() == found.agg(F.sum("copies")).first()[0]
    assert mixture.copies(no_documents(spark)).count() == 0 and mixture.mix(no_documents(spark)).count() == 0


def test_ranks_of_a_hot_key_with_ties(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").alias("k"), (F.col("id") % 5).alias("v"), F.lit(1).alias("range_id"))
    found = ranked(df, ["k"], ["v"], "place")
    assert found.columns == ["k", "v", "range_id", "place"]
    by_key = {}
    for r in found.collect():
        by_key.setdefault(r["k"], []).append((r["place"], r["v"]))
    for rows in by_key.values():
        assert [p for p, _ in sorted(rows)] == list(range(1, len(rows) + 1))
        assert [v for _, v in sorted(rows)] == sorted(v for _, v in rows)
