"""Language of a document from its text, what it declares, its address and its host, by Bayes' rule."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tripworks.llm.frames import free_name, row_key
from tripworks.sources.scratch import materialise

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
# Letter triples are counted in this many cells; with languages fixed, this bounds the model.
CELLS = 1 << 15
# Triples overlap and repeat, so a text counts as fewer independent ones than it has.
TEXT_WEIGHT = 0.2
# What a level must see before it outweighs the level above it: source or host, suffix, all documents.
STRENGTH = 20.0
# Probability that a document is in none of the languages, before anything is read.
UNKNOWN_PRIOR = 1e-3
# Letters of a long text are looked at in runs of this many bytes.
RUN = 1 << 20

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def triples(text: bytes) -> Iterator[np.ndarray]:
    """Cells of all triples of bytes within words, words padded by a space; run by run."""
    clean = b" " + b" ".join(text.translate(_LETTERS).split()) + b" "
    for start in range(0, len(clean) - 2, RUN):
        x = np.frombuffer(clean[start : start + RUN + 2], dtype=np.uint8).astype(np.uint32)
        h = (x[:-2] * np.uint32(0x9E3779B1)) ^ (x[1:-1] * np.uint32(0x85EBCA6B)) ^ (x[2:] * np.uint32(0xC2B2AE35))
        yield (h ^ (h >> np.uint32(15))) % np.uint32(CELLS)


def _packed(parts: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """The same numbers in arrays of about RUN or more, so that each is worth a count."""
    held: list[np.ndarray] = []
    for part in parts:
        held.append(part)
        if sum(map(len, held)) >= RUN:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


def letter_counts(docs: DataFrame, text: str, declared: str, languages: Sequence[str]) -> DataFrame:
    """(language, cell, n): triples of all documents by declared language, summed per task, then over tasks."""
    number = {name: k for k, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), CELLS), dtype=np.int64)
        for batch in batches:
            texts, names = batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()
            for name, k in number.items():
                own = (cells for value, of in zip(texts, names, strict=True) if value and of == name for cells in triples(value))
                for cells in _packed(own):
                    counts[k] += np.bincount(cells, minlength=CELLS)
        which, cell = np.nonzero(counts)
        arrays = [pa.array(which, pa.int64()), pa.array(cell, pa.int64()), pa.array(counts[which, cell], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["language", "cell", "n"])

    narrow = docs.select(F.col(text).cast("string").alias("text"), F.col(declared).cast("string").alias("declared"))
    found = narrow.mapInArrow(run, "language bigint, cell bigint, n bigint")
    return found.groupBy("language", "cell").agg(F.sum("n").alias("n"))


def letter_model(counts: DataFrame, languages: int) -> np.ndarray:
    """Log-likelihood of each cell in each language and, last, in none of them (all cells alike)."""
    table = np.zeros((languages + 1, CELLS))
    for row in counts.collect():  # at most languages x CELLS rows
        table[row["language"], row["cell"]] = row["n"]
    table[-1] = 0
    smooth = table + 0.5
    return np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.copy()


def text_evidence(docs: DataFrame, columns: dict[str, str], model: np.ndarray) -> DataFrame:
    """Per row the named columns, and ``text_score``: weighted log-likelihood of its text in each language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [n for n in columns if n != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            scores = []
            for value in batch.column(0).cast(pa.binary()).to_pylist():
                score = np.zeros(table.shape[1])
                for cells in triples(value or b""):
                    score += np.bincount(cells, minlength=CELLS) @ table if len(cells) > CELLS else table[cells].sum(axis=0)
                scores.append((TEXT_WEIGHT * score).tolist())
            arrays = [*batch.columns[1:], pa.array(scores, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "text_score"])

    kinds = {"row_id": dict(docs.dtypes)[columns["row_id"]]}
    narrow = docs.select(
        F.col(columns["text"]).cast("string").alias("text"),
        *(F.col(columns[n]).cast(kinds.get(n, "string")).alias(n) for n in names),
    )
    schema = ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)
    return narrow.mapInArrow(run, f"{schema}, text_score array<double>")


def _best(scores: Column, names: Column) -> Column:
    """Name with the greatest score; ties go to the earlier one."""
    return F.element_at(names, F.array_position(scores, F.array_max(scores)).cast("int"))


def host_priors(votes: DataFrame, languages: Sequence[str]) -> DataFrame:
    """(host, suffix, prior): P(language | host), smoothed to its suffix, that to all documents.

    ``votes``: (host, suffix, language, n). Sums are combined before each shuffle, so a host with most
    documents costs no more than another.
    """

    def sums() -> list[Column]:
        return [F.coalesce(F.sum(F.when(F.col("language") == x, F.col("n"))), F.lit(0)) for x in languages]

    def lean(n: Column, above: Column) -> Column:
        total = F.aggregate(n, F.lit(0).cast("bigint"), lambda s, x: s + x)
        return F.zip_with(n, above, lambda x, p: (x + STRENGTH * p) / (total + STRENGTH))

    whole = np.array(votes.agg(*sums()).first(), dtype=float)
    whole = (whole + STRENGTH / len(languages)) / (whole.sum() + STRENGTH)
    overall = F.array(*(F.lit(float(x)) for x in whole))
    suffixes = votes.groupBy("suffix").agg(F.array(*sums()).alias("n"))
    suffixes = suffixes.select(F.col("suffix").alias("of"), lean(F.col("n"), overall).alias("p"))
    hosts = votes.groupBy("host", "suffix").agg(F.array(*sums()).alias("n"))
    return hosts.join(suffixes, F.col("suffix").eqNullSafe(F.col("of"))).select(
        "host", "suffix", lean(F.col("n"), F.col("p")).alias("prior")
    )


def identify(
    docs: DataFrame,
    row_id: str,
    text: str,
    declared: str,
    host: str,
    suffix: str | None = None,
    languages: Sequence[str] = LANGUAGES,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """One row (row_id, declared, text_language, language, confidence, accepted) per row of ``docs``.

    Four pieces of evidence are fused by Bayes' rule, as logarithms: the text's letter triples; the
    declared (markup) language, as reliable as declarations are found to be by counting what texts
    in each language declare; the prior of host, smoothed to that of its address suffix, smoothed to
    that of all documents, all by grouped sums of what the texts alone say. The letter model is
    fitted on ``fit_on`` (default: all of ``docs``) and its declared languages.

    Accepted if some language is more likely than none of them. A text without letters, empty or null
    says nothing and is not accepted. Null declaration, host or suffix is a value of its own; a
    declaration outside ``languages`` counts as one shared other value. Ids may be null or repeat.
    """
    docs_from = docs if suffix else docs.withColumn(free_name(docs, "suffix"), F.lit(""))
    columns = {"text": text, "row_id": row_id, "declared": declared, "host": host, "suffix": suffix or free_name(docs, "suffix")}
    counts = letter_counts(fit_on if fit_on is not None else docs, text, declared, languages)
    scored = materialise(text_evidence(docs_from, columns, letter_model(counts, len(languages))), "text-evidence")

    names = F.array(*(F.lit(x) for x in languages))
    silent = F.array_max("text_score") == 0  # no letters: every score is zero
    own = F.when(~silent, _best(F.slice("text_score", 1, len(languages)), names))
    told = F.when(F.col("declared").isin(*languages), F.col("declared")).otherwise(F.when(F.col("declared").isNotNull(), F.lit("other")))
    scored = scored.withColumns({"text_language": own, "told": F.coalesce(told, F.lit("none"))})

    votes = scored.where("text_language is not null").groupBy("host", "suffix", "told", "text_language").agg(F.count(F.lit(1)).alias("n"))
    votes = materialise(votes, "votes")
    values = [*languages, "other", "none"]
    says = votes.groupBy().agg(
        *(F.sum(F.when((F.col("told") == v) & (F.col("text_language") == x), F.col("n")).otherwise(0)) for x in languages for v in values)
    ).first()
    seen = np.array([x or 0 for x in says], dtype=float).reshape(len(languages), len(values)) + 0.5
    seen = np.log(seen / seen.sum(axis=1, keepdims=True))
    reliability = F.create_map(
        *(y for j, v in enumerate(values) for y in (F.lit(v), F.array(*(F.lit(float(x)) for x in seen[:, j]))))
    )
    priors = host_priors(votes.select("host", "suffix", F.col("text_language").alias("language"), "n"), languages)
    priors = priors.toDF("p_host", "p_suffix", "prior")
    met = scored.join(priors, F.col("host").eqNullSafe(F.col("p_host")) & F.col("suffix").eqNullSafe(F.col("p_suffix")), "left")
    flat = F.transform(names, lambda _: F.lit(1.0 / len(languages)))
    fused = F.zip_with(
        F.zip_with(F.slice("text_score", 1, len(languages)), F.transform(F.coalesce("prior", flat), lambda p: F.log(p * (1 - UNKNOWN_PRIOR))), lambda a, b: a + b),
        F.element_at(reliability, F.col("told")),
        lambda a, b: a + b,
    )
    none = F.element_at("text_score", -1) + F.lit(float(np.log(UNKNOWN_PRIOR / len(values))))
    met = met.withColumn("fused", F.concat(fused, F.array(none)))
    top = F.array_max("fused")
    mass = F.aggregate("fused", F.lit(0.0), lambda s, x: s + F.exp(x - top))
    best = _best(F.col("fused"), F.concat(names, F.array(F.lit(UNKNOWN))))
    heard = F.col("text_language").isNotNull()
    return met.select(
        "row_id",
        "declared",
        "text_language",
        F.when(heard, best).otherwise(UNKNOWN).alias("language"),
        F.when(heard, F.round(1 / mass, 6)).otherwise(0.0).alias("confidence"),
        (heard & (best != UNKNOWN)).alias("accepted"),
    )


def keep_identified(docs: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """The documents whose language is accepted, all columns as they were; ``source`` is the host.

    Decisions meet documents by a key over all columns, so every row has its own, with or without an id.
    """
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, row_key(docs))
    named = identify(keyed, key, "text", "lang", "source", languages=languages)
    away = materialise(named.where(~F.col("accepted")).select(F.col("row_id").alias(key)).distinct(), "rejected")
    return keyed.join(away, key, "left_anti").select(*docs.columns)


def page_evidence(pages: DataFrame) -> DataFrame:
    """(page_id, text, declared, host, suffix) of raw pages: bare text, language of the markup, parts of the address."""
    html, url = F.coalesce(F.col("html"), F.lit("")), F.coalesce(F.col("url"), F.lit(""))
    bare = F.regexp_replace(html, r"(?is)<(script|style|title)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;?", " ")
    declared = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([a-z]+)", 1))
    host = F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1))
    return pages.select(
        "page_id", bare.alias("text"), F.nullif(declared, F.lit("")).alias("declared"), host.alias("host"),
        F.regexp_extract(host, r"([^.:]*)(?::\d+)?$", 1).alias("suffix"),
    )
