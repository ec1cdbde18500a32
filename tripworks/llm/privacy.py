"""Personal data in texts, and the words that give it away; DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tripworks.llm.frames import free_name
from tripworks.sources import hadoop
from tripworks.sources.scratch import discard, materialise

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# Each pattern finds what the plain one in its comment finds, leftmost first, but in linear time:
# runs are never given back, and no match is tried inside a run that failed from its start.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ of 16 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must hold for the pattern to be worth trying.
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"

LETTER = r"[\p{L}\p{N}]"
WORD = f"{LETTER}+"
# Pairs, of all that are tested, that may look disclosing by chance.
FALSE_ALARMS = 0.01
# Different texts a pair must meet in: whatever a text alone holds meets there, which says nothing.
FEWEST = 2
# Share of an entity's information a term may give away; from the second on nothing of the term stays.
DISCLOSED = 0.9
REVEALED = 0.99
# An entity with fewer bits, in more than an eighth of all documents, is no secret.
LEAST_BITS = 3.0
# Terms and spans are sent to all tasks up to so many bytes, as measured; beyond, they meet texts in a shuffle.
SENT_BYTES = 8 << 20
# Numbers added up one by one in a running sum; sums of such lots come before them.
LOT = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda s, x: s + x)


def _running(lengths: Column, i: Column) -> Callable[[Column], Column]:
    """Sum of the first ``i`` of ``lengths``, given the sums of its lots."""
    full = (i / LOT).cast("int")
    return lambda lots: _sum(F.slice(lots, F.lit(1), full)) + _sum(F.slice(lengths, full * LOT + 1, i % LOT))


def found(text: Column, pattern: str | Column) -> Column:
    """Matches as (start, end, value), in code points from 0, end exclusive; the pattern may be one per row.

    What lies between matches is as long as the pieces the text splits into; starts are running sums.
    """
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern
    values, between = F.regexp_extract_all(text, regex, F.lit(0)), F.split(text, regex, F.lit(-1))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def spans(v: Column, gaps: Column) -> Column:
        both = F.transform(v, lambda x, i: F.length(x) + F.element_at(gaps, i + 1))

        def each(lengths: Column) -> Column:
            lots = F.transform(F.sequence(F.lit(0), ((F.size(lengths) - 1) / LOT).cast("int")),
                               lambda k: _sum(F.slice(lengths, k * LOT + 1, F.lit(LOT))))

            def place(x: Column, i: Column, sums: Column) -> Column:
                start = _running(lengths, i)(sums) + F.element_at(gaps, i + 1)
                return F.struct(start.alias("start"), (start + F.length(x)).alias("end"), x.alias("value"))

            return let(lots, lambda sums: F.transform(v, lambda x, i: place(x, i, sums)))

        return let(both, each)

    lengths = F.transform(between, F.length)
    return F.when(F.regexp(text, regex), let(values, lambda v: let(lengths, lambda gaps: spans(v, gaps)))).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Digits from the right, every second one doubled, casts out to a multiple of ten."""
    number = F.reverse(_digits(value))
    digit = lambda i: F.substring(number, i, F.lit(1)).cast("int")
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    digits = F.transform(F.sequence(F.lit(1), F.length(number)), lambda i: F.when(i % 2 == 1, digit(i)).otherwise(doubled(digit(i))))
    return _sum(digits) % 10 == 0


def base_spans(text: Column, kind: str) -> Column:
    """Spans of one kind that pass its check."""
    checks = {
        "email": lambda x: F.lit(True),
        "ip": lambda x: x["value"].rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
        "card": lambda x: _luhn(x["value"]),
        "phone": lambda x: F.length(_digits(x["value"])).between(8, 15),
    }
    spans = F.filter(found(text, PATTERNS[kind]), checks[kind])
    if not HINTS[kind]:
        return spans
    return F.when(F.contains(text, F.lit(HINTS[kind])), spans).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))


def _rewritten(text: Column, spans: Column, put: Callable[[Column, Column], Column], drop_late: bool) -> Column:
    """``text`` with ``put(span, where the text is read up to)`` in place of each span, spans in order of start.

    Of overlapping spans the later ones begin where the earlier end; with ``drop_late`` they are not put
    at all. Works lot by lot on the stretch of text a lot covers, so the cost is that of the text and
    the spans, not their product.
    """

    def one(stretch: Column, base: Column) -> Callable[[Column, Column], Column]:
        def step(done: Column, x: Column) -> Column:
            late = x["start"] < done["at"]
            gap = F.substring(stretch, done["at"] - base + 1, F.greatest(x["start"] - done["at"], F.lit(0)))
            parts = F.concat(done["parts"], F.array(gap, put(x, done["at"])))
            return F.struct(
                (F.when(late, done["parts"]).otherwise(parts) if drop_late else parts).alias("parts"),
                F.greatest(done["at"], x["end"]).alias("at"),
            )

        return step

    empty = F.array().cast("array<string>").alias("parts")

    def lot(done: Column, of: Column) -> Column:
        until = F.greatest(done["at"], F.array_max(F.transform(of, lambda x: x["end"])))
        stretch = F.substring(text, done["at"] + 1, until - done["at"])

        def rewrite(cut: Column) -> Column:
            inner = F.aggregate(of, F.struct(empty, done["at"].alias("at")), one(cut, done["at"]))
            return let(inner, lambda o: F.struct(F.concat(done["parts"], F.array(F.array_join(o["parts"], ""))).alias("parts"), o["at"].alias("at")))

        return let(stretch, rewrite)

    lots = F.transform(F.sequence(F.lit(0), ((F.size(spans) - 1) / LOT).cast("int")), lambda k: F.slice(spans, k * LOT + 1, F.lit(LOT)))
    rest = lambda done: F.concat(F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(lots, F.struct(empty, F.lit(0).alias("at")), lot, rest)).otherwise(text)


def _blanked(text: Column, spans: Column) -> Column:
    """``text`` with blanks in place of the spans, as long as before."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))
    return let(ordered, lambda o: _rewritten(text, o, lambda x, at: F.repeat(F.lit(" "), x["end"] - F.greatest(x["start"], at)), False))


def _distinct_words(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower))


def mark_base(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with a ``row`` number and ``base`` spans (kind, start, end, value).

    Also the names these columns got, so none of ``docs`` is replaced.
    """
    names = {n: free_name(docs, n) for n in ("row", "whole", "base")}
    typed = docs.withColumns({names["row"]: F.monotonically_increasing_id(), names["whole"]: F.coalesce(F.col(text).cast("string"), F.lit(""))})
    whole = F.col(names["whole"])

    def named(kind: str) -> Column:
        return F.transform(base_spans(whole, kind), lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value")))

    return typed.withColumn(names["base"], F.concat(*map(named, KINDS))).drop(names["whole"]), names


def evidence(total: Column | float, d: Column, t: Column, b: Column) -> Column:
    """Bits that speak against chance for a term in ``t`` and an entity in ``d`` of ``total`` documents meeting in ``b``.

    The bound of Chernoff on how likely independent ones meet so often.
    """
    n = F.lit(float(total))
    chance = d * t / n
    bits = b * F.log2(b * n / (d * t)) - (b - chance) * F.log2(F.exp(F.lit(1.0)))
    return F.when(b > chance, bits).otherwise(0.0)


def share(total: float, d: Column, t: Column, b: Column) -> Column:
    """Share of an entity's bits that a term tells: log2(N b / (d t)) of log2(N / d); null for an entity without any."""
    n = F.lit(float(total))
    informs = F.log2(n / d)
    return F.when(informs > 0, F.log2(n * b / (d * t)) / informs)


def _entity_sets(mentions: DataFrame) -> DataFrame:
    """(row, d, texts, h, g): sets of documents, by size, different texts and two hashes, that an entity of a row occurs in.

    Entities of the same documents disclose alike and are one set, so a list of addresses is one.
    """
    value = F.transform("base", lambda x: F.struct(x["kind"].alias("kind"), F.lower(x["value"]).alias("value")))
    held = mentions.select("row", "text_hash", F.explode(F.array_distinct(value)).alias("e")).select("row", "text_hash", "e.kind", "e.value")
    held = materialise(held, "entities")
    per_text = held.groupBy("kind", "value", "text_hash").agg(
        F.count(F.lit(1)).alias("d"),
        F.sum(F.xxhash64("row").cast("decimal(20,0)")).alias("h"),
        F.bit_xor(F.xxhash64("row", F.lit(1))).alias("g"),
    )
    sets = per_text.groupBy("kind", "value").agg(
        F.sum("d").alias("d"), F.count(F.lit(1)).alias("texts"), F.sum("h").alias("h"), F.bit_xor("g").alias("g")
    )
    found_sets = materialise(
        held.join(materialise(sets, "entity-counts"), ["kind", "value"]).select("row", "text_hash", "d", "texts", "h", "g").distinct(), "entity-sets"
    )
    discard(held)
    return found_sets


def _sent(table: DataFrame) -> DataFrame:
    """A written table, to be sent to all tasks of a join if it is small by its bytes."""
    small = hadoop.size(table.sparkSession, table.inputFiles()) <= SENT_BYTES
    return F.broadcast(table) if small else table


def co_occurrence(texts: DataFrame, total: int) -> DataFrame:
    """(d, texts, h, g, term, df, b, seen, needed): entity sets and terms that might be told, with their counts.

    ``texts`` has row, text_hash, text and base. d, df and b count documents with the entity, the term and
    both, over whole texts; ``seen`` counts the different texts among b, as copies are no evidence of
    their own. A term is looked up in all documents only if, going by the documents that mention an
    entity, some pair of it could reach the share and the ``needed`` bits: more documents with it lower both.
    """
    mentions = texts.where(F.size("base") > 0)
    mentions = materialise(mentions.withColumn("words", _distinct_words(_blanked(F.col("text"), F.col("base")))).drop("text"), "mentions")
    sets = _entity_sets(mentions)
    per_row = sets.groupBy("row").agg(F.count(F.lit(1)).alias("n"))
    tested = mentions.join(per_row, "row").agg(F.sum(F.size("words") * F.col("n"))).first()[0] or 1
    needed = math.log2(tested / FALSE_ALARMS)
    bits = F.log2(F.lit(float(max(total, 1))) / F.col("d"))
    able = sets.where((F.col("texts") >= FEWEST) & (bits >= LEAST_BITS) & (evidence(total, F.col("texts"), F.col("texts"), F.col("texts")) >= needed))
    able = materialise(able, "able-sets")
    rows = mentions.join(able.select("row").distinct(), "row", "left_semi")
    held = materialise(rows.select("row", "text_hash", F.explode("words").alias("term")), "held-terms")
    # documents with the term among these: no more than all that have it, no fewer than those of any pair
    near = held.groupBy("term", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    near = near.groupBy("term").agg(F.sum("n").alias("near"), F.count(F.lit(1)).alias("in_texts")).where(F.col("in_texts") >= FEWEST)
    near = materialise(near.select("term", "near"), "near-terms")
    pairs = held.join(near, "term").join(able.drop("text_hash"), "row")
    pairs = pairs.where(share(total, F.col("d"), F.col("near"), F.least("d", "near")) >= DISCLOSED)
    met = pairs.groupBy("d", "texts", "h", "g", "term", "near", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    met = met.groupBy("d", "texts", "h", "g", "term", "near").agg(F.sum("n").alias("b"), F.count(F.lit(1)).alias("seen"))
    met = materialise(met.where(_telling(total, "near", needed)).withColumn("needed", F.lit(needed)), "pairs")
    # of the pairs left, how many documents have the term at all
    words = F.when(F.size("base") > 0, _blanked(F.col("text"), F.col("base"))).otherwise(F.col("text"))
    counts = texts.select(F.explode(_distinct_words(words)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    if met.isEmpty():  # nothing to look up
        counts = counts.limit(0)
    met = materialise(met.drop("near").join(counts, "term"), "co-occurrence")
    discard(mentions, sets, able, held, near)
    return met


def _telling(total: float, t: str, needed: float) -> Column:
    """Whether a pair reaches share and evidence, with ``t`` documents that have the term.

    Those of them without the entity might be copies of few texts: they count as texts of their own here,
    which only lowers the evidence.
    """
    told = share(total, F.col("d"), F.col(t), F.col("b")) >= DISCLOSED
    different = F.greatest("seen", F.col(t) - F.col("b") + F.col("seen"))
    return told & (F.col("seen") >= FEWEST) & (evidence(total, F.col("texts"), different, F.col("seen")) >= needed)


def told_terms(texts: DataFrame, total: int) -> DataFrame:
    """(term, removed): terms that give an entity away, see ``disclosing``."""
    met = co_occurrence(texts, total)
    told = met.where(_telling(total, "df", F.col("needed")))
    most = share(total, F.col("d"), F.col("df"), F.col("b"))
    return told.groupBy("term").agg(F.bool_or(most >= REVEALED).alias("removed"))


def disclosing(marked: DataFrame, names: dict[str, str], text: str = "text") -> DataFrame:
    """(row, terms): per row with any, (start, end, removed) of words that give away an entity, by start.

    With N documents, an entity in d of them carries log2(N/d) bits. A term in t of them, in b together
    with the entity, tells log2(N b / (d t)) of those. The share told must reach ``DISCLOSED``, in ``FEWEST``
    different texts at least, and that they meet so often must not be chance: over all pairs of an entity
    and a term that meet anywhere, about ``FALSE_ALARMS`` would by chance. From ``REVEALED`` on a term is removed, below that generalised,
    wherever it stands, also in documents without the entity.
    """
    texts = marked.select(
        F.col(names["row"]).alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.col(names["base"]).alias("base")
    )
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    told = materialise(told_terms(texts, marked.count()), "told")
    seen = F.when(F.size("base") > 0, _blanked(F.col("text"), F.col("base"))).otherwise(F.col("text"))
    words = texts.select("row", F.explode(_distinct_words(seen)).alias("term"))
    hits = words.join(_sent(told), "term").groupBy("row").agg(F.collect_list(F.struct("term", "removed")).alias("told"))
    hits = materialise(hits, "hits")
    discard(told)

    met = texts.withColumn("seen", seen).join(_sent(hits), "row").withColumn("names", F.col("told.term"))
    # the words of the row that are told, as they are written there, make its own pattern
    forms = F.filter(F.array_distinct(F.regexp_extract_all("seen", F.lit(WORD), F.lit(0))), lambda w: F.array_contains("names", F.lower(w)))
    pattern = F.concat(F.lit(rf"(?<!{LETTER})(?:"), F.array_join(forms, "|"), F.lit(rf")(?!{LETTER})"))
    met = met.withColumn("pattern", pattern)
    erased = lambda w: F.exists("told", lambda t: (t["term"] == F.lower(w["value"])) & t["removed"])
    span = lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), erased(w).alias("removed"))
    return met.select("row", F.transform(found(F.col("seen"), F.col("pattern")), span).alias("terms"))


def find(docs: DataFrame, keep: list[str], text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """The columns ``keep`` with base spans and ``terms``: array of (start, end, removed) by start, or null."""
    marked, names = mark_base(docs, text)
    kept = dict.fromkeys([*keep, text])
    marked = materialise(marked.select(*kept, *(names[n] for n in ("row", "base"))), "base-spans", "zstd")
    terms = disclosing(marked, names, text)
    names["terms"] = free_name(marked, "terms")
    of = free_name(marked, "of_row")
    terms = materialise(terms.select(F.col("row").alias(of), F.col("terms").alias(names["terms"])), "term-spans")
    met = marked.join(_sent(terms), F.col(names["row"]) == F.col(of), "left")
    return met.select(*keep, *(names[n] for n in ("row", "base", "terms"))), names


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ``base`` (kind, start, end, value) and ``terms`` (start, end, removed).

    Spans are in code points, end exclusive, by kind as in ``KINDS``, then by start. Null text is
    empty and has none. Ids may be null or repeat; other columns are not looked at. Which terms give
    an entity away is estimated from all documents; repeated rows count as documents of their own.
    """
    met, names = find(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), ["doc_id"])
    return met.select("doc_id", F.col(names["base"]).alias("base"), F.col(names["terms"]).alias("terms"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind, disclosing terms by [TERM] or nothing.

    Where spans overlap, the part not yet replaced goes with the earlier one. ``n_chars``, if there is
    such a column, follows the text. A null text stays null. All rows and other columns stay.
    """
    met, names = find(docs, docs.columns)
    base = F.transform(names["base"], lambda x: F.struct(x["start"], x["end"], F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")).alias("put")))
    terms = F.transform(names["terms"], lambda x: F.struct(x["start"], x["end"], F.when(x["removed"], "").otherwise(f"[{TERM.upper()}]").alias("put")))
    spans = F.array_sort(F.concat(base, F.coalesce(terms, F.array().cast("array<struct<start:int,end:int,put:string>>"))))
    text = F.col("text").cast("string")
    changed = let(spans, lambda o: _rewritten(text, o, lambda x, at: x["put"], True))
    out = met.withColumn("text", changed)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out.select(*docs.columns)
