"""Merkle tree over a dataset: leaf digests, roots, proofs of membership and their check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tripworks.llm.frames import lower_ascii, prepare, ranked
from tripworks.sources.scratch import materialise

# Consecutive nodes that become one.
ARITY = 16
# Rows whose id has a CRC-32 this divides are the ones tampered with.
TAMPERED = 5
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def hashed(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """Byte count, colon, value; ``-`` for null. No two rows of values read the same."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return hashed(F.concat(*map(field, values)))


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Add run, slot, length (of the run), ``left`` and ``right`` (digests of earlier and later siblings) to (key, idx, digest).

    One window with a lag and a lead column per offset, over the nodes in order; a lag counts where
    the slot reaches so far back, a lead where the run's length reaches so far on. Runs are apart, so
    a window never holds more than ``ARITY`` rows and a key of any size spreads over all tasks.
    """
    placed = nodes.withColumns(
        {"run": F.floor(F.col("idx") / ARITY).cast("bigint"), "slot": (F.col("idx") % ARITY).cast("int")}
    )
    run = W.partitionBy("key", "run")
    along = run.orderBy("idx")
    offsets = range(1, ARITY)
    read = placed.select(
        "*",
        F.count(F.lit(1)).over(run).cast("int").alias("length"),
        *(F.lag("digest", k).over(along).alias(f"lag_{k}") for k in offsets),
        *(F.lead("digest", k).over(along).alias(f"lead_{k}") for k in offsets),
    )
    left = [F.when(F.col("slot") >= k, F.col(f"lag_{k}")).otherwise("") for k in reversed(offsets)]
    right = [F.when(F.col("slot") + k < F.col("length"), F.col(f"lead_{k}")).otherwise("") for k in offsets]
    return read.select(
        *placed.columns, "length", F.concat(*left).alias("left"), F.concat(*right).alias("right")
    )


def alone() -> Column:
    """Whether a node is all its key has at this level: then it is the key's root."""
    return (F.col("run") == 0) & (F.col("length") == 1)


def parents(level: DataFrame) -> DataFrame:
    """The next level: rows that are first children hash themselves and what follows in their run."""
    first = level.where((F.col("slot") == 0) & ~alone())
    return first.select("key", F.col("run").alias("idx"), hashed(F.concat("digest", "right")).alias("digest"))


def climb(leaves: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels above the leaves, each with siblings, and the root (key, digest) of every key.

    Levels are written: each is a sixteenth of the one below, and their number grows with the
    logarithm of the largest key.
    """
    lowest = with_siblings(leaves)
    roots = lowest.where(alone()).select("key", "digest")
    levels: list[DataFrame] = []
    above = materialise(parents(lowest), f"{name}-nodes")
    while not above.isEmpty():
        level = materialise(with_siblings(above), f"{name}-level")
        levels.append(level)
        roots = roots.unionByName(level.where(alone()).select("key", "digest"))
        above = materialise(parents(level), f"{name}-nodes")
    return levels, roots


STEP = "array<struct<left: string, right: string>>"


def descend(levels: Sequence[DataFrame], tops: DataFrame) -> DataFrame:
    """Per run of leaves (key, idx), the siblings met from its own node up to the key's root, and what ``tops`` adds.

    ``tops``: per key, ``path`` (siblings above the key's root) and columns to hand down. A key with one
    leaf has no node above it; its run 0 gets what its top has.
    """
    handed = [c for c in tops.columns if c not in ("key", "path")]
    below = None
    for level in reversed(levels):
        own = F.array(F.struct("left", "right")).cast(STEP)
        at_top = level.where(alone()).join(tops, "key").select("key", "idx", "path", *handed)
        if below is not None:
            parent = below.select("key", F.col("idx").alias("run"), "path", *handed)
            met = level.where(~alone()).join(parent, ["key", "run"])
            at_top = at_top.unionByName(met.select("key", "idx", F.concat(own, "path").alias("path"), *handed))
        below = materialise(at_top, "paths")
    single = tops.select("key", F.lit(0).cast("bigint").alias("idx"), "path", *handed)
    if below is None:
        return single
    reached = below.where("idx = 0").select("key")
    return below.unionByName(single.join(reached, "key", "left_anti"))


def folded(digest: Column, path: Column) -> Column:
    """The root that a digest and the siblings on its path lead to."""
    return F.aggregate(path, digest, lambda at, step: hashed(F.concat(step["left"], at, step["right"])))


def siblings(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    doc_id: str = "doc_id",
    group: str = "source",
    text: str = "text",
    tampered: int = TAMPERED,
) -> DataFrame:
    """One row (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of ``docs``.

    A leaf is the digest of the row's ``columns``. Per group, leaves ascend by id, and every ``ARITY``
    consecutive nodes become the digest of their digests until one is left, the subroot; subroots, by
    group, likewise give the root. The proof of a row is the digests of all siblings on its way up. The
    check folds the row as it is found, with its proof, and compares with the root: rows whose id has a
    CRC-32 that ``tampered`` divides are found with A-Z of their text lower-cased.

    Null is a group of its own, first in order; null ids come first in their group and are not tampered with.
    Rows that share an id ascend by their leaf. Null fields are told from empty ones. No rows, no root.
    Other columns are not looked at. A row's texts are read once and never shuffled.
    """
    prepare(docs.sparkSession)
    values = [F.col(c) for c in columns]
    lowered = [lower_ascii(F.col(text)) if c == text else F.col(c) for c in columns]
    hit = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % tampered == 0, F.lit(False))
    # a key that is never null and sorts null first, then by bytes
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    digests = docs.select(
        F.col(doc_id).alias("doc_id"),
        key.alias("key"),
        leaf_digest(values).alias("digest"),
        F.when(hit, leaf_digest(lowered)).alias("found"),
    )
    placed = ranked(materialise(digests, "leaves"), ["key"], ["doc_id", "digest"], "place")
    leaves = materialise(placed.withColumn("idx", F.col("place") - 1).drop("place"), "leaves")
    levels, roots = climb(leaves.select("key", "idx", "digest"), "groups")

    ordered = ranked(materialise(roots.select(F.col("key").alias("group"), "digest"), "subroots"), [], ["group"], "place")
    tops = materialise(ordered.select("group", F.lit("").alias("key"), (F.col("place") - 1).alias("idx"), "digest"), "subroots")
    over, root = climb(tops.select("key", "idx", "digest"), "dataset")
    above = descend(over, root.select("key", F.array().cast(STEP).alias("path"), F.col("digest").alias("root")))
    placed_groups = with_siblings(tops.select("key", "idx", "digest", "group"))
    subtree = _joined(placed_groups, above, ["root"]).select(
        F.col("group").alias("key"), "path", F.col("digest").alias("subroot"), "root"
    )
    runs = descend(levels, materialise(subtree, "subroots"))

    met = _joined(with_siblings(leaves), runs, ["subroot", "root"])
    end = folded(F.coalesce("found", "digest"), F.col("path"))
    return met.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        hashed(siblings(F.col("path"))).alias("proof_sha256"),
        end.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _joined(nodes: DataFrame, runs: DataFrame, handed: Sequence[str]) -> DataFrame:
    """Nodes with their whole path: their own siblings, then those of their run."""
    up = runs.select("key", F.col("idx").alias("run"), F.col("path").alias("rest"), *handed)
    own = F.when(alone(), F.array().cast(STEP)).otherwise(F.array(F.struct("left", "right")).cast(STEP))
    carried = [c for c in nodes.columns if c not in ("run", "slot", "length", "left", "right")]
    return nodes.join(up, ["key", "run"]).select(*carried, F.concat(own, "rest").alias("path"), *handed)
