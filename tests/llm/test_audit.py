"""Filter audit against filters applied one by one, in every order."""

import random
import re
from itertools import permutations

import numpy as np
import pandas as pd
from llm_cases import no_documents, odd_documents, odd_rows, rows_of

from tripworks.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(text):
    words = WORD.findall(text)
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
        "D": re.search(r"[#$%&*|]", text) is not None,
    }


def brute(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    judged = []
    for i, text, source in docs:
        f = fails(text or "")
        f["E"] = i is not None and any(j is not None and j < i and (u or "") == (text or "") for j, u, _ in docs)
        judged.append((source or "", i, f))
    out = []
    for part in {p for p, _, _ in judged}:
        own = [(i, f) for p, i, f in judged if p == part]
        rows, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = list(range(len(own)))
            for step, letter in enumerate(order, 1):
                gone = [k for k in left if own[k][1][letter]]
                left = [k for k in left if not own[k][1][letter]]
                shapley[letter] += len(gone)
                fail = [k for k in range(len(own)) if own[k][1][letter]]
                only = [k for k in fail if sum(own[k][1].values()) == 1]
                lost = [sum(own[k][0] in s for k in gone) for s in (good, toxic)]
                rows.append((part, order, step, len(left), len(gone), len(fail) - len(gone), len(only), *lost, letter))
        out += [(*r[:-1], shapley[r[-1]]) for r in rows]
    return sorted(out, key=str)


def test_counts_are_those_of_filters_applied_in_turn(spark):
    rng = random.Random(5)
    words = "a the Of STONE river one# two three four five six seven eight nine ten eleven".split()
    docs = []
    for i in range(120):
        n, few = rng.choice([0, 10, 49, 50, 70]), rng.choice([3, 16])
        docs.append((rng.randrange(100) if rng.random() > 0.1 else None, " ".join(rng.choice(words[-few:]) + rng.choice(["", str(i)]) for _ in range(n)) if rng.random() > 0.05 else None, rng.choice(["a", "b", "", None])))
    docs += [(rng.randrange(200), rng.choice(docs)[1], rng.choice("ab")) for _ in range(80)] + docs[:5]
    labels = [(rng.randrange(150) if rng.random() > 0.1 else None, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(120)]
    found = audit.interactions(
        spark.createDataFrame(docs, "doc_id bigint, text string, source string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )
    assert rows_of(found) == brute(docs, labels)


def test_a_tensor_is_contracted_as_its_cells_add_up():
    rng = np.random.default_rng(1)
    letters = "XYZ"
    cells = pd.DataFrame({"mask": range(8), **{k: rng.integers(0, 9, 8) for k in audit.MEASURES}})
    got = audit.steps_of(letters, cells)
    bit = {c: 1 << i for i, c in enumerate(letters)}
    assert len(got) == 18
    for r in got.itertuples():
        this, earlier = r.filter_order[r.step - 1], r.filter_order[: r.step - 1]
        fail = cells[(cells["mask"] & bit[this]) > 0]
        here = fail[~fail["mask"].map(lambda m: any(m & bit[c] for c in earlier))]
        assert (r.removed, r.good_lost, r.toxic_lost) == tuple(here[list(audit.MEASURES)].sum())
        assert r.redundant == fail["n"].sum() - r.removed and r.unique_fails == cells["n"][bit[this]]
        assert r.shapley == got["removed"][[o[s - 1] == this for o, s in zip(got["filter_order"], got["step"])]].sum()


def test_odd_documents(spark):
    labels = spark.createDataFrame([(1, 1, 0, 7), (1, 0, 1, 7), (None, 1, 1, 7), (6, None, None, 7)], "doc_id bigint, quality int, toxic int, text int")
    found = rows_of(audit.interactions(odd_documents(spark), labels))
    assert found == brute([(r[0], r[1], r[3]) for r in odd_rows()], [(1, 1, 0), (1, 0, 1)])
    assert audit.interactions(no_documents(spark), labels).count() == 0


def test_copies_without_end_are_one_row_per_task(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "'same text' as text", "'s' as source")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = audit.interactions(docs, none).where("filter_order = 'EABCD'").orderBy("step").collect()
    assert [r["removed"] for r in found] == [19_999, 1, 0, 0, 0]
