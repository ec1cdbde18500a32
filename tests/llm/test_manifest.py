"""Merkle manifest against a tree built by hand."""

import hashlib
import random
import zlib

import pytest
from llm_cases import no_documents, odd_documents, odd_rows, rows_of

from tripworks.llm import manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """The root, and per leaf its siblings (earlier, later) level by level."""
    paths, level, above = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        runs = [range(k, min(k + 16, len(level))) for k in range(0, len(level), 16)]
        for run in runs:
            for i in run:
                for x in above[i]:
                    paths[x].append(("".join(level[run[0] : i]), "".join(level[i + 1 : run[-1] + 1])))
        above = [[x for i in run for x in above[i]] for run in runs]
        level = [h("".join(level[run[0] : run[-1] + 1])) for run in runs]
    return (level[0] if level else None), paths


def brute(docs):
    """docs: (doc_id, source, lang, n_chars, text)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sources = sorted({d[1] for d in docs}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted(((d[0] is not None, d[0] or 0, leaf(d), d) for d in docs if d[1] == s), key=lambda x: x[:3])
        trees[s] = (own, *tree([x[2] for x in own]))
    root, over = tree([trees[s][1] for s in sources])
    out = []
    for s, top in zip(sources, over, strict=True):
        own, subroot, paths = trees[s]
        for (_, _, digest, d), path in zip(own, paths, strict=True):
            path = path + top
            hit = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0
            at = leaf((*d[:4], d[4].translate(lower))) if hit and d[4] is not None else digest
            for left, right in path:
                at = h(left + at + right)
            out.append((d[0], digest, subroot, root, h("".join(a + b for a, b in path)), at, at == root))
    return sorted(out, key=str)


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize("sizes", [[1], [16], [17, 1, 16, 256], [257], [1] * 40, [4097, 3], [2, 0, 300]])
def test_roots_proofs_and_checks_are_those_of_the_tree(spark, sizes):
    rng = random.Random(sum(sizes))
    names = [None, "", *(f"s{k:02d}é" for k in range(len(sizes)))]
    docs = [(rng.randrange(10**6), names[k], rng.choice(["en", None]), n, f"Text {n} of {k} ÀB") for k, n_docs in enumerate(sizes) for n in range(n_docs)]
    rng.shuffle(docs)
    assert rows_of(manifest.manifest(spark.createDataFrame(docs, SCHEMA))) == brute(docs)


def test_tampering_is_told_by_the_check(spark):
    docs = [(i, "a", "en", 1, "Up" if i % 2 else "low") for i in range(200)]
    found = {r["doc_id"]: r["verified"] for r in manifest.manifest(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert found == {i: not (zlib.crc32(str(i).encode()) % 5 == 0 and i % 2) for i in range(200)}


def test_odd_documents(spark):
    docs = [(r[0], r[3], r[2], r[4], r[1]) for r in odd_rows()]
    assert rows_of(manifest.manifest(odd_documents(spark))) == brute(docs)
    assert manifest.manifest(no_documents(spark)).count() == 0


def test_windows_hold_a_run_and_lags_stop_at_its_ends(spark):
    nodes = spark.createDataFrame([("k", i, f"<{i}>") for i in range(35)], "key string, idx bigint, digest string")
    got = {r["idx"]: r for r in manifest.with_siblings(nodes).collect()}
    for i, r in got.items():
        lo, hi = i // 16 * 16, min(i // 16 * 16 + 16, 35)
        assert r["left"] == "".join(f"<{k}>" for k in range(lo, i)) and r["right"] == "".join(f"<{k}>" for k in range(i + 1, hi))
        assert (r["run"], r["slot"], r["length"]) == (i // 16, i % 16, hi - lo)
