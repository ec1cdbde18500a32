"""Near-duplicates by SimHash and a covering family of bit masks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tripworks.llm.frames import components, free_name, row_key
from tripworks.sources.scratch import materialise

SEED = 42
BITS = 64
# Hashes counted at once; a long text is taken in runs of this many shingles.
RUN = 1 << 16
# Fingerprints of one bucket that are compared one by one; fuller buckets are linked exactly
# through the values between the fingerprints instead, see near_links.
BUCKET = 32


def fingerprint(text: bytes, length: int = 3) -> int:
    """SimHash of one text, as a signed 64-bit number. No words: zero."""
    words = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    if len(words) < length:
        shingles, total = iter([b" ".join(words)]), 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(length)), strict=False))
        total = len(words) - length + 1
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, total, RUN):
        run = np.fromiter(hashes, dtype="<u8", count=min(RUN, total - start))
        counts += np.unpackbits(run.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 3, key: str | None = None) -> DataFrame:
    """One row (doc_id, fp) per row of ``docs``; with ``key``, a column of strings, that one too."""
    more = [key] if key else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = [fingerprint(t or b"", length) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64()), *batch.columns[2:]], names=["doc_id", "fp", *more])

    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), *more)
    return narrow.mapInArrow(run, ", ".join(["doc_id bigint, fp bigint", *(f"`{c}` string" for c in more)]))


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks such that any ``radius`` positions lie outside at least one of them.

    Position i gets a vector m(i) of radius+1 bits, mask v the positions whose m(i) has an odd
    overlap with v. At most ``radius`` positions give as many linear equations in radius+1
    unknowns, so some v other than zero solves all of them: that mask leaves these positions out.
    """
    size = (1 << (radius + 1)) - 1
    return [
        sum(1 << i for i in range(bits) if (v & (1 + i % size)).bit_count() % 2) for v in range(1, size + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _ball(fp: Column, radius: int) -> Column:
    """All values that differ from ``fp`` in at most ``radius`` (0 or 1) bits."""
    flips = [0] if radius == 0 else [0, *(_signed(1 << i) for i in range(BITS))]
    return F.array(*(fp.bitwiseXOR(F.lit(x)) for x in flips))


def near_links(nodes: DataFrame, radius: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) whose components are those of "differs in at most ``radius`` bits". ``nodes``: distinct fp.

    Fingerprints meet in a table of the covering family if they agree under its mask; those in
    buckets of up to ``bucket`` are compared. A fuller bucket would make too many pairs. Its
    fingerprints are written down with every value within one bit: two of them are within two bits
    exactly if they share such a value, at most 65 can share one, and all that do are linked to the
    least. For other radii than two the fuller buckets are compared like the rest.
    """
    keys = F.explode(
        F.array(
            *(
                F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"))
                for t, mask in enumerate(covering_masks(radius))
            )
        )
    )
    placed = nodes.select("fp", keys.alias("k")).select("k.table", "k.key", "fp")
    full = placed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    full = materialise(full, "buckets")
    met = materialise(placed.join(full, ["table", "key"]), "placed")
    limit = bucket if radius == 2 else (1 << 62)
    few = met.where(F.col("n") <= limit)
    distance = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp")))
    pairs = (
        few.alias("x")
        .join(few.alias("y"), (F.col("x.table") == F.col("y.table")) & (F.col("x.key") == F.col("y.key"))
              & (F.col("x.fp") < F.col("y.fp")) & (distance <= radius))
        .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    )
    crowd = met.where(F.col("n") > limit).select("fp").distinct()
    between = crowd.select("fp", F.explode(_ball(F.col("fp"), 1)).alias("z"))
    shared = between.groupBy("z").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    stars = shared.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return pairs.union(stars).distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 3, radius: int = 2
) -> DataFrame:
    """One row (doc_id, fp, component_id) per row of ``docs``, component_id the least doc_id reachable.

    Words are runs of anything but ASCII white space, A-Z lower-cased; shingles of ``length`` words
    count as often as they occur. Null and empty texts have fingerprint zero and are linked like any
    other. Equal fingerprints are one node, so a group of copies of any size is one row of the graph.
    Null ids take no part in the least id; a component of null ids only has a null component_id.
    Repeated rows come back repeated; columns other than these two are not looked at.
    """
    marked = materialise(fingerprints(docs, doc_id, text, length), "fingerprints")
    lookup = _least_reached(marked, F.col("doc_id"), radius).withColumnRenamed("least", "component_id")
    return marked.join(lookup, "fp", "left").select("doc_id", "fp", "component_id")


def _least_reached(marked: DataFrame, value: Column, radius: int) -> DataFrame:
    """(fp, least): the least ``value`` among the rows of ``marked`` that links reach from each fingerprint."""
    nodes = materialise(marked.groupBy("fp").agg(F.min(value).alias("first")), "nodes")
    reach = components(near_links(nodes.select("fp"), radius))
    linked = materialise(reach.join(nodes, reach.node == nodes.fp).select("fp", "root", "first"), "linked")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    named = linked.join(least, "root").select("fp", "least")
    return nodes.join(named, "fp", "left").select("fp", F.coalesce("least", "first").alias("least"))


def keep_one(docs: DataFrame, length: int = 3, radius: int = 2) -> DataFrame:
    """One row of ``docs`` per component of its near-duplicates; all columns as they were.

    Of a component the row with the least doc_id stays, null ids last; of rows that share it the one with
    the least key over all columns. Rows are told apart by that key, so rows with one id and different
    texts are judged apart, and rows equal in all columns are one.
    """
    key, doc_id = free_name(docs, "row_key"), "doc_id"
    keyed = docs.withColumn(key, row_key(docs))
    marked = materialise(fingerprints(keyed, doc_id, "text", length, key), "fingerprints")
    first = _least_reached(marked, F.struct(F.col("doc_id").isNull(), "doc_id", F.col(key).alias("key")), radius)
    kept = materialise(first.select(F.col("least.key").alias(key)).distinct(), "kept")
    often = marked.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = materialise(often.select(key).join(kept, key, "left_semi"), "equal-rows")
    stay = keyed.join(kept, key, "left_semi")
    if again.isEmpty():
        return stay.select(*docs.columns)
    once = stay.join(again, key, "left_semi").dropDuplicates([key])
    return stay.join(again, key, "left_anti").select(*docs.columns).union(once.select(*docs.columns))
