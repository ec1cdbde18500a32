"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tripworks.llm.frames import free_name, ranked
from tripworks.sources.scratch import materialise

WEIGHTS = (5.0, 2.0, 1.0)
# Words of the mix per word of all sources, and the most copies of one document.
BUDGET = 1.5
MOST = 2.0
SEED = "mix"


def n_words(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float], budget: float, most: float) -> DataFrame:
    """Add ``target`` to (source, source_size): the budget in proportion to weights, none above ``most`` times its size.

    Sources take the weights in turn, by code point with null last. The share per unit of weight is
    found by passes over the small source table: give every source that is not full its share, mark
    those that now have too much as full, share again what is left. A full source stays full, since
    shares only grow, so the passes end.
    """
    order = sizes.select("source", "source_size", F.col("source").isNull().alias("no_source"))
    placed = ranked(order, [], ["no_source", "source"], "place").drop("no_source")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int") + 1)
    table = materialise(placed.withColumn("weight", weight), "sources")
    full, share = F.lit(False), 0.0
    total = table.agg(F.sum("source_size")).first()[0] or 0
    marked = -1
    while True:
        row = table.agg(
            F.sum(F.when(full, F.col("source_size")).otherwise(0)).alias("taken"),
            F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("weight"))).alias("weight"),
            F.count_if(full).alias("full"),
        ).first()
        if row["full"] == marked or not row["weight"]:
            break
        marked = row["full"]
        share = (budget * total - most * row["taken"]) / row["weight"]
        full = F.col("weight") * share > most * F.col("source_size")
    target = F.when(full, most * F.col("source_size")).otherwise(F.col("weight") * share)
    return table.withColumn("target", target.cast("double"))


def offset(source: Column) -> Column:
    """The random start of a source, in [0, 1): 48 bits of a digest of seed and name."""
    name = F.coalesce(F.concat(F.lit(f"{SEED}:"), source), F.lit(SEED))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 12), 16, 10).cast("bigint") / F.lit(float(1 << 48))


def copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    most: float = MOST,
) -> DataFrame:
    """One row (doc_id, source, size, source_size, target, copies) per row of ``docs``.

    Every document of a source is expected as often as any other: target over source size. With
    documents in order of size, then of a digest of the id, the expected copies add up along the
    source; a document is emitted once per whole number its stretch crosses, counted from a random
    offset. Order by size makes what is taken follow the target to within about one long document.

    Null text has size 0 and an empty source target 0, hence no copies. Null is a source of its own.
    Rows that share a doc_id are documents of their own. Other columns are not looked at.
    """
    tie = F.md5(F.concat(F.lit(f"{SEED}:"), F.col(doc_id).cast("string")).cast("binary"))
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), n_words(F.col(text).cast("string")).alias("size"), tie.alias("tie")
    )
    sized = materialise(sized, "sizes")  # texts are read once, though ranking looks at its input twice
    place = materialise(ranked(sized, ["source"], ["size", "tie"], "place"), "places").drop("tie")
    sums = materialise(place.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    share = targets(sums, weights, budget, most).select(F.col("source").alias("of"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    until = F.floor(F.col("rate") * F.col("place") + F.col("start"))
    before = F.floor(F.col("rate") * (F.col("place") - 1) + F.col("start"))
    return (
        place.join(share, F.col("source").eqNullSafe(F.col("of")))
        .withColumns({"rate": rate, "start": offset(F.col("source"))})
        .select("doc_id", "source", "size", "source_size", "target", (until - before).alias("copies"))
    )


def _key(size: str) -> Column:
    """doc_id, size and source as one text that is never null and tells them apart."""
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("?"))
    return F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("?")), F.col(size).cast("string"), source)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture: each row of ``docs`` as often as ``copies`` says, with its ``copy`` number from 1.

    Rows equal in doc_id, source and size share the copies found for them, the first of them (by a
    digest of the text) one more if they do not divide evenly. A ``copy`` column of ``docs`` is replaced.
    """
    rest = docs.drop(*(c for c in docs.columns if c.lower() == "copy"))
    taken = copies(rest, **options)
    size, key, nth = (free_name(rest, n) for n in ("mixed_size", "mixed_key", "mixed_nth"))
    of, got = free_name(rest, "mixed_of"), free_name(rest, "mixed_got")
    total = taken.withColumn(key, _key("size")).groupBy(key).agg(F.sum("copies").alias("total"), F.count(F.lit(1)).alias("rows"))
    total = total.where("total > 0").select(F.col(key).alias(of), F.struct("total", "rows").alias(got))
    sized = rest.withColumn(size, n_words(F.col("text").cast("string")))
    sized = sized.withColumn(key, _key(size))
    # joined and numbered by the one key, so texts are shuffled once
    met = sized.join(total, sized[key] == total[of])
    order = W.partitionBy(key).orderBy(F.xxhash64("text"))
    n, rows = F.col(got)["total"], F.col(got)["rows"]
    share = F.floor(n / rows) + (F.col(nth) <= n % rows).cast("bigint")
    each = F.sequence(F.lit(1), share.cast("int"))
    numbered = met.withColumn(nth, F.row_number().over(order)).where(share > 0)
    return numbered.withColumn("copy", F.explode(each)).select(*rest.columns, "copy")
