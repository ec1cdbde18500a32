"""Personal data against plain patterns, and disclosure against counts by hand."""

import math
import random
import re
import time

import pytest
from llm_cases import no_documents, odd_documents, rows_of

from tripworks.llm import privacy
from tripworks.llm.frames import prepare

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def brute(text):
    out = []
    for kind in privacy.KINDS:
        for m in re.finditer(PLAIN[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    marked, names = privacy.mark_base(df)
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r[names["base"]]] for r in marked.collect()}


FIXED = [
    "a@b.c@d.e", "a@b.c.@d.e x@y", "@b.c", "a@b..c", "a@b.c-d.é", "1.2.3.4", "256.1.1.1 1.2.3.4.5.6.7.8", "001.02.3.255", "1.2.3.4.",
    "4539 5787 6362 1486", "4539-5787-6362-1486 4539578763621486", "45395787636214861", "4539  5787 6362 1486", "+1 (555) 010-0000",
    "+1555", "++15550100000", "+1 - ( 5", "😀 a@b.cd 1.1.1.1 😀 +1 555 010 0000", "", None, "5", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
]


def test_spans_are_those_of_the_plain_patterns(spark):
    rng = random.Random(6)
    parts = ["a", "b.c", "@", ".", "-", "+", " ", "  ", "1", "12", "255", "256", "4539578763621486", "(", ")", "é", "😀", "\n", "_", "%", "0.0.0.0", "a@b.de"]
    texts = FIXED + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))) for _ in range(1500)]
    got = found(spark, texts)
    for i, text in enumerate(texts):
        assert got[i] == brute(text), text


@pytest.mark.parametrize("text", ["1 " * 150_000, "1" * 300_000, "a" * 300_000, "a@" * 100_000, "+1 " * 100_000, "1.1." * 8_000, "a@b.c " * 5_000])
def test_very_long_texts_are_read_in_linear_time(spark, text):
    start = time.time()
    got = found(spark, [text])[0]
    assert time.time() - start < 60
    if text.startswith("a@b"):
        assert got == [("email", 6 * i, 6 * i + 5) for i in range(5_000)]


def disclosure_docs(spark):
    # "Zorro" stands beside the same address in 6 documents and nowhere else, "Alba" in 6 but in 3 more too,
    # "said" everywhere; the address of the last document occurs once
    texts = [f"then Zorro and Alba said hello to zz@mail.org in case {i}" for i in range(6)]
    texts += [f"Alba said nothing about case {i} today" for i in range(3)] + ["once Pedro said once@mail.org"] + [f"they said word{i}" for i in range(90)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), texts


def evidence(total, d, t, b):
    chance = d * t / total
    return b * math.log2(b / chance) - (b - chance) / math.log(2) if b > chance else 0.0


def words_of(text):
    return [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text)]


def brute_terms(texts):
    """Spans of told terms per document, from sets of documents."""
    seen, entities = [], []
    for text in texts:
        spans, blank = brute(text), list(text or "")
        for _, a, b in spans:
            blank[a:b] = " " * (b - a)
        seen.append("".join(blank))
        entities.append({(kind, text[a:b].lower()) for kind, a, b in spans})
    total, terms = len(texts), [{w for w, _, _ in words_of(t)} for t in seen]
    holds = {}
    for i, found_in in enumerate(entities):
        for e in found_in:
            holds.setdefault(e, set()).add(i)
    sets = {frozenset(x) for x in holds.values()}
    tested = sum(len(terms[i]) * len({frozenset(holds[e]) for e in entities[i]}) for i in range(total)) or 1
    needed, told = math.log2(tested / privacy.FALSE_ALARMS), {}
    different = lambda docs: len({texts[i] for i in docs})
    for docs in sets:
        if math.log2(total / len(docs)) < privacy.LEAST_BITS:
            continue
        for term in set().union(*(terms[i] for i in docs)):
            both, df = [i for i in docs if term in terms[i]], sum(term in t for t in terms)
            share = math.log2(total * len(both) / (len(docs) * df)) / math.log2(total / len(docs))
            sure = evidence(total, different(docs), df - len(both) + different(both), different(both))
            if share >= privacy.DISCLOSED and sure >= needed and different(both) >= privacy.FEWEST:
                told[term] = told.get(term, False) or share >= privacy.REVEALED
    return [[(a, b, told[w]) for w, a, b in words_of(t) if w in told] for t in seen]


def terms_found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found_in = {r["doc_id"]: [(s["start"], s["end"], s["removed"]) for s in r["terms"] or []] for r in privacy.personal_data(df).collect()}
    return [found_in[i] for i in range(len(texts))]


def test_terms_beside_an_entity_are_judged_by_their_information(spark):
    prepare(spark)
    df, texts = disclosure_docs(spark)
    got = {r["doc_id"]: r["terms"] or [] for r in privacy.personal_data(df).collect()}
    total = len(texts)

    def share(d, t, b):
        return math.log2(total * b / (d * t)) / math.log2(total / d)

    assert share(6, 6, 6) == 1 and share(6, 9, 6) < privacy.DISCLOSED
    for i in range(6):
        words = {texts[i][s["start"] : s["end"]]: s["removed"] for s in got[i]}
        assert words["Zorro"] and "Alba" not in words and "said" not in words and "mail" not in words
    assert all(not got[i] for i in range(6, total))
    assert terms_found(spark, texts) == brute_terms(texts)


def test_terms_told_are_those_of_counts_by_hand(spark):
    prepare(spark)
    rng = random.Random(11)
    names = [f"name{i}" for i in range(12)]
    words = [f"word{i}" for i in range(60)]
    texts = []
    for i in range(700):
        who = rng.randrange(40)
        parts = [rng.choice(words) for _ in range(rng.randrange(1, 12))]
        if who < len(names):
            parts += [names[who]] * (rng.random() < 0.9) + [f"mail{who}@box.org"] * (rng.random() < 0.8) + ["+1 555 010 0000"] * (rng.random() < 0.5)
        elif rng.random() < 0.05:
            parts.append(rng.choice(names))
        rng.shuffle(parts)
        texts.append(" ".join(parts))
    texts += texts[:40] + [None, "", "mail0@box.org"] + ["once@box.org with a rareword"] + ["copy@box.org copied words twice"] * 30
    want = brute_terms(texts)
    assert sum(map(len, want)) > 20 and terms_found(spark, texts) == want


def test_what_is_seen_once_tells_nothing_however_large_the_corpus(spark):
    prepare(spark)
    texts = ["then Pedro said one@mail.org"] + [f"then they said again{i}" for i in range(5000)]
    assert not any(terms_found(spark, texts))
    # nor do copies of one text: they are one observation
    assert not any(terms_found(spark, texts + texts[:1] * 50))


def test_an_entity_in_most_documents_is_no_secret(spark):
    prepare(spark)
    texts = [f"contact office@mail.org about imprint {i}" for i in range(60)] + [f"other text {i}" for i in range(60)]
    assert not any(terms_found(spark, texts))


def test_terms_are_counted_and_spanned_over_whole_texts(spark):
    prepare(spark)
    far = " they said" * 60
    texts = [f"Zorro{far} to zz@mail.org{far} by ZORRO {i}" for i in range(6)] + ["Zorro came"] + [f"they said to word{i} by far" for i in range(4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: [texts[r["doc_id"]][s["start"] : s["end"]] for s in r["terms"] or []] for r in privacy.personal_data(df).collect()}
    assert all(got[i] == ["Zorro", "ZORRO"] for i in range(6))
    assert got[6] == ["Zorro"]  # no mention there, but the name gives it away all the same
    assert not any(got[i] for i in range(7, len(texts)))


def test_words_have_their_places(spark):
    text = "\U0001f600 " + "".join("-" * (i % 5) + f" Wört{i % 40}x" for i in range(700)) + " !İx İx2"
    for pattern in (r"(?<![\p{L}\p{N}])(?:Wört7x|İx|Wört39x)(?![\p{L}\p{N}])", "Wört0x", "none"):
        df = spark.createDataFrame([(text, pattern)], "t string, p string")
        row = df.select(privacy.found(privacy.F.col("t"), privacy.F.col("p")).alias("w")).first()
        plain = pattern.replace(r"[\p{L}\p{N}]", r"[^\W_]")
        assert [(w["value"], w["start"], w["end"]) for w in row["w"]] == [(m[0], m.start(), m.end()) for m in re.finditer(plain, text)]


def test_sanitised_texts(spark):
    prepare(spark)
    df, texts = disclosure_docs(spark)
    out = {r["doc_id"]: r["text"] for r in privacy.sanitise(df).collect()}
    assert out[9] == "once Pedro said [EMAIL]"
    assert "Zorro" not in out[0] and "[EMAIL]" in out[0] and "Alba said" in out[0]
    assert out[7] == texts[7]
    overlap = "to 1.2.3.4@mail.org and 4539578763621486"
    one = spark.createDataFrame([(1, overlap, len(overlap))], "doc_id bigint, text string, n_chars bigint")
    r = privacy.sanitise(one).first()
    assert r["text"] == "to [IP] and [CARD]" and r["n_chars"] == len(r["text"])


def test_odd_documents(spark):
    prepare(spark)
    docs = odd_documents(spark)
    out = privacy.sanitise(docs)
    assert out.dtypes == docs.dtypes and out.count() == docs.count()
    untouched = "doc_id in (1, 2, 3, 4, 5, 8)"
    assert rows_of(out.where(untouched)) == rows_of(docs.where(untouched))
    assert privacy.personal_data(no_documents(spark)).count() == 0 and privacy.sanitise(no_documents(spark)).count() == 0


def test_plans_hold_no_python(spark):
    prepare(spark)
    for df in (privacy.personal_data(disclosure_docs(spark)[0]), privacy.sanitise(disclosure_docs(spark)[0])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_running_sums_over_lots(spark):
    text = "x" + "a@b.c" + "".join("-" * (i % 7) + " a@b.c" for i in range(700))
    assert found(spark, [text])[0] == brute(text)
