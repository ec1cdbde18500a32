"""Benchmark passages in documents, found by multi-pattern search over words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripworks.llm.frames import free_name, lower_ascii
from tripworks.sources.scratch import discard, materialise

WINDOW = 13
# Bytes of the windows searched for in one pass over the documents: bounds what is sent to every task.
PASS_BYTES = 64 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CLEAN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased; words are runs of digits, a-z and everything beyond ASCII."""
    return text.translate(_CLEAN).split()


class WuManber:
    """Search for many word sequences at once. One table per length, so short ones do not slow the others.

    ``shift`` tells for a block of ``BLOCK`` words how far a window may move on when it ends with that
    block: to the block's nearest place in any pattern, or past it if no pattern has it. Where the
    shift is zero, patterns with that last block and the text's first block are compared word by word.
    """

    BLOCK = 2

    def __init__(self, patterns: Iterable[tuple[tuple[bytes, ...], int]]):
        grouped: dict[int, list] = defaultdict(list)
        for pattern, name in patterns:
            grouped[len(pattern)].append((pattern, name))
        self.tables = []
        for size, group in sorted(grouped.items()):
            block = min(self.BLOCK, size)
            shift: dict[tuple, int] = {}
            buckets: dict[tuple, dict[tuple, list]] = defaultdict(lambda: defaultdict(list))
            for pattern, name in group:
                for end in range(block, size + 1):
                    key = pattern[end - block : end]
                    shift[key] = min(shift.get(key, size), size - end)
                buckets[pattern[-block:]][pattern[:block]].append((pattern, name))
            self.tables.append((size, block, shift, {k: dict(v) for k, v in buckets.items()}))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(start, length, name) of every occurrence."""
        for size, block, shift, buckets in self.tables:
            far, end, total = size - block + 1, size, len(words)
            while end <= total:
                key = tuple(words[end - block : end])
                step = shift.get(key, far)
                if step:
                    end += step
                    continue
                start = end - size
                for pattern, name in buckets[key].get(tuple(words[start : start + block]), ()):
                    if pattern == tuple(words[start:end]):
                        yield start, size, name
                end += 1


def windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: (words, items); ``size`` consecutive words, or all of a shorter item's."""
    words = F.regexp_extract_all(lower_ascii(F.col(text).cast("string")), F.lit(WORD), F.lit(0))
    last = F.greatest(F.size("w") - size, F.lit(0))
    starts = F.explode(F.sequence(F.lit(0), last))
    return (
        benchmark.where(F.col(text).isNotNull() & F.col(item_id).isNotNull())
        .select(F.col(item_id).cast("string").alias("item"), words.alias("w"))
        .where(F.size("w") > 0)
        .select("item", "w", starts.alias("s"))
        .select("item", F.slice("w", F.col("s") + 1, F.lit(size)).alias("words"))
        .groupBy("words")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def _passes(found: DataFrame, most: int) -> Iterator[list]:
    """Windows in lots of about ``most`` bytes, one lot on the driver at a time; an empty lot if there are none."""
    size = lambda names: F.aggregate(names, F.lit(0), lambda n, x: n + F.octet_length(x) + 60)
    lots = max(1, -(-(found.agg(F.sum(size("words") + size("items"))).first()[0] or 0) // most))
    lot = F.pmod(F.xxhash64("words"), F.lit(lots))
    for k in range(lots):
        yield found.where(lot == k).collect()


def _disjoint(spans: Iterable[tuple[int, int]]) -> list[int]:
    """Ranges merged where they touch: start, end, start, end and so on."""
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _scan(docs: DataFrame, text: str, n_words: str, hits: str, items: str, lot: list) -> DataFrame:
    """Count words, and add the occurrences of one lot's windows to ``hits`` (word ranges) and ``items``."""
    shared = docs.sparkSession.sparkContext.broadcast(
        ([(tuple(w.encode() for w in r["words"]), k) for k, r in enumerate(lot)], [r["items"] for r in lot])
    )
    names = docs.columns
    at = {name: names.index(name) for name in (text, n_words, hits, items)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns, owners = shared.value
        engine = WuManber(patterns)
        for batch in batches:
            columns = list(batch.columns)
            before, seen = columns[at[hits]].to_pylist(), columns[at[items]].to_pylist()
            sizes = []
            for row, value in enumerate(columns[at[text]].cast(pa.binary()).to_pylist()):
                words = words_of(value or b"")
                sizes.append(len(words))
                found = list(engine.search(words))
                if found:
                    spans = [(start, start + size) for start, size, _ in found]
                    before[row] = _disjoint([*zip(before[row][::2], before[row][1::2], strict=True), *spans])
                    seen[row] = sorted({*seen[row], *(x for _, _, k in found for x in owners[k])})
            columns[at[n_words]] = pa.array(sizes, pa.int64())
            columns[at[hits]] = pa.array(before, pa.list_(pa.int64()))
            columns[at[items]] = pa.array(seen, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW, most: int = PASS_BYTES
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_items`` (sorted item ids as strings) and ``contaminated``.

    A document is contaminated if words inside windows are at least a twentieth of its words. The
    documents are scanned once per ``most`` bytes of distinct windows, and written between scans, so what a
    task holds does not grow with the benchmark. Null and empty texts have no words and are clean; items without words or id have
    no windows; repeated rows and items count as they are. Columns of ``docs`` that have one of the
    new names are replaced.
    """
    new = ("n_words", "n_hit", "hit_items", "contaminated")
    rest = docs.drop(*(c for c in docs.columns if c in new and c != text))
    hits = free_name(rest, "hit_ranges")
    empty = {"n_words": F.lit(None).cast("bigint"), hits: F.array().cast("array<bigint>"), "hit_items": F.array().cast("array<string>")}
    marked = rest.withColumns(empty)
    before = None
    for k, lot in enumerate(_passes(materialise(windows(benchmark, size=size), "windows"), most)):
        if k:  # the scan before this one has ended before the next lot is sent
            marked = materialise(marked, "scanned")
            discard(*([before] if before else []))
            before = marked
        marked = _scan(marked, text, "n_words", hits, "hit_items", lot)
    length = F.transform(hits, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    n_hit = F.aggregate(length, F.lit(0).cast("bigint"), lambda total, x: total + x)
    measured = marked.withColumn("n_hit", n_hit).drop(hits)
    bad = (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))
    return measured.withColumn("contaminated", bad)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, all columns as they were."""
    keep = {c: free_name(docs, f"kept_{c}") for c in docs.columns if c in ("n_words", "n_hit", "hit_items", "contaminated")}
    held = docs.withColumnsRenamed(keep)
    clean = contamination(held, benchmark).where(~F.col("contaminated"))
    return clean.select(*(F.col(keep.get(c, c)).alias(c) for c in docs.columns))

