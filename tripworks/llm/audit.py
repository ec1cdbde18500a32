"""How quality filters interact: what each removes in every order, from one small tensor per part."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tripworks.llm.frames import prepare
from tripworks.sources.scratch import materialise

WHITE_SPACE = r"[\x20\x09-\x0D]+"
FEWEST_WORDS = 50
# Least distinct words, and most capitals, per hundred.
DISTINCT_PER_100 = 65
CAPITALS_PER_100 = 5
SIGNS = r"[#$%&*|]"
# The filter that asks whether an earlier document has the same text; the others look at the text alone.
REPEATED = "E"

# What an axis of the tensor is multiplied with: index 0 counts documents that pass, index 1 those that fail.
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
MEASURES = ("n", "good", "toxic")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions on a text that is not null, by the letter of their filter."""
    words = F.array_remove(F.split(text, WHITE_SPACE), "")
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < FEWEST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PER_100 * n,
        "C": 100 * capitals > CAPITALS_PER_100 * F.length(text),
        "D": text.rlike(SIGNS),
    }


def failures(
    docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column], doc_id: str, text: str, part: str
) -> DataFrame:
    """Documents per (part, mask, n, good, toxic): mask has a bit for each filter that fails, in order of the letters.

    Whether an earlier document has the same text is asked of the digest: the least id per digest, with
    the cells its rows belong to, is found by an aggregate that is combined before the shuffle, so a text
    with any number of copies is a row per task. All rows less those are what fails.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    letters = [*filters, REPEATED]
    bit = {letter: 1 << i for i, letter in enumerate(letters)}
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"),
        sum((F.when(fails, bit[k]).otherwise(0) for k, fails in filters.items()), F.lit(0)).alias("mask"),
    )
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("of")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    same = narrow.groupBy("doc_id", "digest", "mask", "part").agg(F.count(F.lit(1)).alias("n"))
    rows = same.join(marks, F.col("doc_id") == F.col("of"), "left").select(
        "doc_id", "digest", "mask", "part", "n", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic"))
    )
    rows = materialise(rows, "audited")
    # a row with no id is not later than any, nor earlier
    once = rows.where("doc_id is null").select("mask", "part", "n", "good", "toxic")
    alike = rows.where("doc_id is not null").groupBy("digest", "doc_id", "mask", "good", "toxic")
    alike = alike.agg(F.collect_list(F.struct("part", "n")).alias("cells"))
    first = alike.groupBy("digest").agg(F.min(F.struct("doc_id", "mask", "good", "toxic", "cells")).alias("first"))
    first = first.select("first.*").select("mask", "good", "toxic", F.inline("cells"))
    passing = first.select("mask", "part", "n", "good", "toxic").union(once)
    signed = rows.select("mask", "part", "n", "good", "toxic", F.lit(True).alias("every")).union(
        passing.withColumn("every", F.lit(False))
    )

    def counted(what: Column, which: Column) -> Column:
        return F.coalesce(F.sum(F.when(which & what, F.col("n"))), F.lit(0))

    every = F.col("every")
    kinds = {"n": F.lit(True), "good": F.col("good"), "toxic": F.col("toxic")}
    sums = signed.groupBy("part", "mask").agg(
        *(counted(what, every).alias(f"all_{k}") for k, what in kinds.items()),
        *(counted(what, ~every).alias(f"pass_{k}") for k, what in kinds.items()),
    )
    cell = F.array(
        F.struct("mask", *(F.col(f"pass_{k}").alias(k) for k in kinds)),
        F.struct(
            (F.col("mask") + bit[REPEATED]).alias("mask"),
            *((F.col(f"all_{k}") - F.col(f"pass_{k}")).alias(k) for k in kinds),
        ),
    )
    return sums.select("part", F.inline(cell)).where("n > 0")


def selectors(letters: str) -> tuple[list[str], dict[str, np.ndarray]]:
    """All orders, and per question an array [order, step, axis, 2] of what each axis is contracted with."""
    orders = ["".join(p) for p in permutations(letters)]
    asked = {q: np.empty((len(orders), len(letters), len(letters), 2), np.int64) for q in ("removed", "kept", "fails", "only")}
    for o, order in enumerate(orders):
        for step in range(len(letters)):
            for axis, letter in enumerate(letters):
                place = order.index(letter)
                asked["removed"][o, step, axis] = PASS if place < step else FAIL if place == step else ALL
                asked["kept"][o, step, axis] = PASS if place <= step else ALL
                asked["fails"][o, step, axis] = FAIL if place == step else ALL
                asked["only"][o, step, axis] = FAIL if place == step else PASS
    return orders, asked


def contract(tensor: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Counts [measure, order, step]: the tensor [measure, 2, 2, ...] summed over its axes as ``asked`` selects."""
    n = asked.shape[2]
    operands: list = [tensor, [0, *range(3, 3 + n)]]
    for axis in range(n):
        operands += [asked[:, :, axis], [1, 2, 3 + axis]]
    return np.einsum(*operands, [0, 1, 2], optimize="greedy")


def steps_of(letters: str, cells: pd.DataFrame) -> pd.DataFrame:
    """All orders and steps of one part from its cells, at most one per mask."""
    n = len(letters)
    flat = np.zeros((len(MEASURES), 1 << n), np.int64)
    np.add.at(flat, (slice(None), cells["mask"].to_numpy()), cells[list(MEASURES)].to_numpy(np.int64).T)
    # bit i of a mask is axis i: the last axis of the reshaped array is the lowest bit
    tensor = flat.reshape(len(MEASURES), *(2,) * n).transpose(0, *range(n, 0, -1))
    orders, asked = selectors(letters)
    removed, good, toxic = contract(tensor, asked["removed"])
    kept, fails, only = (contract(tensor[:1], asked[q])[0] for q in ("kept", "fails", "only"))
    acts = np.array([[letters.index(c) for c in order] for order in orders])
    shapley = np.zeros(n, np.int64)
    np.add.at(shapley, acts, removed)
    return pd.DataFrame(
        {
            "filter_order": np.repeat(orders, n),
            "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders)),
            "kept": kept.ravel(),
            "removed": removed.ravel(),
            "redundant": (fails - removed).ravel(),
            "unique_fails": only.ravel(),
            "good_lost": good.ravel(),
            "toxic_lost": toxic.ravel(),
            "shapley": shapley[acts].ravel(),
        }
    )


SCHEMA = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def interactions(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Column] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """One row per part, order of the filters and step, with what that step's filter does there.

    ``filters`` are failure conditions by letter (those of ``text_filters`` by default), to which comes E:
    the text is that of a smaller id anywhere in the table. Per part, documents are counted by which
    filters they fail; that tensor, an axis of length 2 per filter, is contracted with pass, fail or all
    along every axis. kept: pass this and all earlier steps. removed: fail here first. redundant: fail
    here, removed earlier. unique_fails: fail only here. good_lost, toxic_lost: removed with such a
    label. shapley: what this filter removes, summed over all orders.

    Null text is empty, null part the empty name, which it shares with empty ones. A row without id has
    no label, is never a repeat and makes none; rows that share an id and a text are no repeats of each other.
    Of several labels of an id any that says 1 counts; null labels say nothing. No rows, no parts. Other
    columns are not looked at.
    """
    prepare(docs.sparkSession)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    chosen = text_filters(whole) if filters is None else dict(filters)
    letters = "".join([*chosen, REPEATED])
    cells = failures(docs, labels, chosen, doc_id, text, part)

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        found = steps_of(letters, group)
        found.insert(0, "part", key[0])
        return found

    return cells.groupBy("part").applyInPandas(run, SCHEMA)
