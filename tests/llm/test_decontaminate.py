"""Search and contamination against brute force."""

import random
import re

import pytest
from llm_cases import no_documents, odd_documents, rows_of

from tripworks.llm import decontaminate
from tripworks.llm.decontaminate import WuManber
from tripworks.llm.frames import prepare


def words(text):
    return re.findall(decontaminate.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, size=13):
    doc, hit, who = words(text), set(), set()
    for item, body in items:
        w = words(body)
        for k in range(max(len(w) - size, 0) + 1) if w and item is not None else ():
            window = w[k : k + size]
            for p in range(len(doc) - len(window) + 1):
                if doc[p : p + len(window)] == window:
                    hit.update(range(p, p + len(window)))
                    who.add(str(item))
    return len(doc), len(hit), sorted(who)


def test_search_finds_every_occurrence():
    rng = random.Random(4)
    for _ in range(60):
        alphabet = [b"a", b"b", b"c"][: rng.choice([1, 2, 3])]
        patterns = [tuple(rng.choice(alphabet) for _ in range(rng.choice([1, 2, 3, 5, 5]))) for _ in range(8)]
        text = [rng.choice(alphabet) for _ in range(rng.randrange(40))]
        found = sorted(WuManber([(p, k) for k, p in enumerate(patterns)]).search(text))
        expected = [(i, len(p), k) for k, p in enumerate(patterns) for i in range(len(text)) if tuple(text[i : i + len(p)]) == p]
        assert found == sorted(expected)
    assert list(WuManber([]).search([b"a"])) == []


def test_words():
    text = "Ab-c Éé  x\x7fy 12z !"
    assert [w.decode() for w in decontaminate.words_of(text.encode())] == words(text)


ITEMS = [
    (1, "the river ran past the old stone mill and over the green hills into the sea"),
    (2, "two words"), (3, ""), (4, None), (None, "the river"), (5, "Two  WORDS!"), (6, "one"), (7, "stone stone stone"),
]


@pytest.mark.parametrize("most", [3_000, 10_000, decontaminate.PASS_BYTES])
def test_contamination_is_that_of_brute_force(spark, most):
    prepare(spark)
    rng = random.Random(2)
    texts = [ITEMS[0][1], "x " * 500 + ITEMS[0][1], "Two-words are one", "stone " * 9, "a b c", None, "", "the river ran past the old stone mill and over the green"]
    texts += [" ".join(rng.choice("the river ran past two words one stone".split()) for _ in range(300)) for _ in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for r in decontaminate.contamination(docs, benchmark, most=most).collect():
        n, hit, who = brute(r["text"], ITEMS)
        assert (r["n_words"], r["n_hit"], r["hit_items"]) == (n, hit, who)
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)


def test_odd_documents_and_empty_tables(spark):
    prepare(spark)
    docs = odd_documents(spark)
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    clean = decontaminate.clean_documents(docs, benchmark)
    assert clean.dtypes == docs.dtypes
    expected = [tuple(r) for r in docs.collect() if not (lambda n, h, _: h > 0 and 20 * h >= n)(*brute(r["text"], ITEMS))]
    assert rows_of(clean) == sorted(expected, key=str)
    assert rows_of(decontaminate.clean_documents(docs, nothing)) == rows_of(docs)
    assert decontaminate.contamination(no_documents(spark), benchmark).count() == 0
