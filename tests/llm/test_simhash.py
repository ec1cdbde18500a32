"""Covering masks, fingerprints and components against brute force."""

import itertools
import random
import re

import pytest
import xxhash
from llm_cases import sentence, no_documents, odd_documents, odd_rows, rows_of
from pyspark.sql import functions as F

from tripworks.llm import simhash
from tripworks.llm.frames import components, prepare


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Least id reachable over at most two differing bits."""
    root = {i: i for i in fps}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in itertools.combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in fps}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_small_difference(radius):
    masks = simhash.covering_masks(radius, 24)
    for places in itertools.combinations(range(24), radius):
        difference = sum(1 << p for p in places)
        assert any(m & difference == 0 for m in masks)


@pytest.mark.parametrize("text", ["", "a", "A b", "Ab c D e", "é b c \x1c d", "x " * 200_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) & (1 << 64) - 1 == brute_fingerprint(text)


@pytest.mark.parametrize("bucket", [0, 3, 32])
def test_links_lose_no_pair(spark, bucket):
    rng = random.Random(bucket)
    seeds = [rng.getrandbits(64) for _ in range(20)]
    fps = {i: rng.choice(seeds) ^ sum(1 << rng.randrange(64) for _ in range(rng.choice([0, 1, 1, 2, 3]))) & (1 << 64) - 1 for i in range(400)}
    nodes = spark.createDataFrame([(simhash._signed(x),) for x in set(fps.values())], "fp bigint")
    found = {r["node"]: r["root"] for r in components(simhash.near_links(nodes, bucket=bucket)).collect()}
    expected = brute_components({simhash._signed(x) & (1 << 64) - 1: x for x in fps.values()})
    groups = {}
    for x in set(fps.values()):
        groups.setdefault(found.get(simhash._signed(x), x), set()).add(expected[x])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(expected.values()))


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(201, 202), (202, 203), (203, 201), (7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {i: 201 for i in (201, 202, 203)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_odd_documents(spark):
    prepare(spark)
    rows = [(r[0], r[1]) for r in odd_rows()]
    found = simhash.near_duplicates(odd_documents(spark)).collect()
    assert len(found) == len(rows)
    fps = {i: brute_fingerprint(t) for i, t in rows if i is not None}
    expected = brute_components(fps)
    for r in found:
        if r["doc_id"] is not None:
            assert (r["fp"] & (1 << 64) - 1, r["component_id"]) == (fps[r["doc_id"]], expected[r["doc_id"]])
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    prepare(spark)
    docs = odd_documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    ids = [r["doc_id"] for r in kept.collect()]
    expected = brute_components({r[0]: brute_fingerprint(r[1]) for r in odd_rows() if r[0] is not None})
    assert sorted(i for i in ids if i is not None) == sorted(set(expected.values()))
    assert ids.count(None) == 1  # the one without text is a copy of others without words
    assert simhash.keep_one(no_documents(spark)).count() == 0


def test_partitioning_does_not_matter(spark):
    docs = odd_documents(spark).where(F.col("doc_id").isNotNull())
    assert rows_of(simhash.near_duplicates(docs.coalesce(1))) == rows_of(simhash.near_duplicates(docs.repartition(5)))


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    prepare(spark)
    text, other = sentence(60, 2), sentence(60, 77)
    rows = [(1, text), (2, text), (2, other), (2, other), (None, text), (None, other), (None, sentence(60, 78)), (None, sentence(60, 78))]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert rows_of(kept) == sorted([(1, text), (2, other), (None, sentence(60, 78))], key=str)


def test_a_hub_with_very_many_links_is_one_component(spark):
    edges = spark.range(1, 50_000).selectExpr("id as a", "0L as b")
    found = components(edges.union(spark.createDataFrame([(60_000, 60_001)], "a bigint, b bigint")))
    assert found.groupBy("root").count().orderBy("root").collect() == [(0, 50_000), (60_000, 2)]
