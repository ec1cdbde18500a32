"""Filter of page addresses: rules first, then a tree of path templates per host; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tripworks.llm.frames import free_name, lower_ascii
from tripworks.sources.scratch import materialise

ALLOW, BLOCK = "allow", "block"
ANY, NUMBER = "*", "{n}"
# A segment stays as it is if its branch has this share of its parent's pages, and this many. A node with
# fewer pages below it is not divided further.
SHARE = 0.02
ENOUGH = 5
# Neighbouring branches closer than this many standard errors in their share of allowed pages are one.
CLOSE = 1.0
# Labelled pages that outweigh what the parent says; the tree's root says PRIOR.
STRENGTH = 5.0
PRIOR = 0.5


@dataclass(frozen=True)
class Rule:
    """A verdict on a host with its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def rules(*texts: str) -> list[Rule]:
    """From lines like ``block example.com/en/``."""
    out = []
    for line in texts:
        verdict, address = line.split(" ", 1)
        host, _, path = address.partition("/")
        out.append(Rule(verdict, host, f"/{path}"))
    return out


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without an address."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, given: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or null; of equally long ones the first by code point."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(given, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = rule.fits(host, path)
        text, verdict = F.when(fits, F.lit(rule.text)).otherwise(text), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def shape(path: Column) -> Column:
    """Segments of a path, all of them, digits as one wildcard."""
    segments = F.split(F.regexp_replace(path, "^/", ""), "/", -1)
    return F.transform(segments, lambda s: F.regexp_replace(s, "[0-9]+", r"\{n\}"))


def _purity(good: str, bad: str, above: Column) -> Column:
    return (F.col(good) + STRENGTH * above) / (F.col(good) + F.col(bad) + STRENGTH)


def _branches(tree: DataFrame, level: int) -> DataFrame:
    """(host, parent, segment, label, purity): the children of all nodes of a level, generalised and merged."""
    segment = F.element_at("shape", level + 1)
    sums = [F.sum(c).alias(c) for c in ("n", "good", "bad")]
    children = tree.where(F.size("shape") > level).groupBy("host", F.col("template").alias("parent"), segment.alias("segment"))
    children = materialise(children.agg(*sums, F.max("purity").alias("above")), "children")
    # both sides of a join are written, so that adaptive execution can split the part of a parent with most segments
    whole = materialise(children.groupBy("host", "parent").agg(F.sum("n").alias("whole")).where(F.col("whole") >= ENOUGH), "wholes")
    own = children.join(whole, ["host", "parent"])
    stays = (F.col("n") >= ENOUGH) & (F.col("n") >= SHARE * F.col("whole"))
    named = materialise(own.withColumn("name", F.when(stays, F.col("segment")).otherwise(ANY)).drop("whole"), "named")
    # at most 1 / SHARE names and the wildcard per parent from here on
    names = named.groupBy("host", "parent", "name").agg(*sums, F.max("above").alias("above"))
    labelled = F.col("good") + F.col("bad")
    rate = (F.col("good") + STRENGTH * F.col("above")) / (labelled + STRENGTH)
    names = names.withColumns({"labelled": labelled, "rate": rate})
    line = W.partitionBy("host", "parent").orderBy(F.col("labelled") > 0, "rate", "name")
    before = {c: F.lag(c).over(line) for c in ("rate", "labelled")}
    spread = lambda r, n: r * (1 - r) / (n + STRENGTH)
    error = F.sqrt(spread(F.col("rate"), F.col("labelled")) + spread(before["rate"], before["labelled"]))
    silent = (F.col("labelled") > 0) & (before["labelled"] == 0)
    apart = before["rate"].isNull() | silent | (F.col("rate") - before["rate"] > CLOSE * error)
    names = names.withColumn("apart", apart.cast("int"))
    names = names.withColumn("branch", F.sum("apart").over(line.rowsBetween(W.unboundedPreceding, 0)))
    merged = names.groupBy("host", "parent", "branch").agg(
        F.array_join(F.array_sort(F.collect_set("name")), "|").alias("label"),
        F.collect_set("name").alias("members"),
        F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.max("above").alias("above"),
    )
    purity = F.when(F.col("good") + F.col("bad") == 0, PRIOR).otherwise(_purity("good", "bad", F.col("above")))
    merged = materialise(merged.select("host", "parent", F.explode("members").alias("name"), "label", purity.alias("purity")), "merged")
    return named.select("host", "parent", "segment", "name").join(merged, ["host", "parent", "name"]).drop("name")


def templates(labelled: DataFrame) -> DataFrame:
    """(host, shape, template, purity) for all shapes of paths, from rows (host, path, verdict or null).

    Rows are summed by host and shape first, so a host with most pages is as few rows as it has kinds
    of paths. The tree grows level by level, as deep as some node has ``ENOUGH`` pages below it. In each, rare segments become a wildcard; the branches of
    a node, by their share of allowed pages, are merged with the next while they are statistically
    alike; and a branch's purity is its share of allowed pages, smoothed to its parent's. Nothing
    speaks against a branch without labelled pages: it is merged with its like only, and its purity
    is PRIOR.
    """
    good, bad = (F.sum((F.col("verdict") == v).cast("bigint")) for v in (ALLOW, BLOCK))
    tree = labelled.groupBy("host", shape(F.col("path")).alias("shape")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(good, F.lit(0)).alias("good"), F.coalesce(bad, F.lit(0)).alias("bad")
    )
    tree = materialise(tree, "shapes")
    hosts = tree.groupBy("host").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    hosts = hosts.select("host", _purity("good", "bad", F.lit(PRIOR)).alias("purity"))
    tree = tree.join(hosts, "host").withColumn("template", F.lit(""))
    for level in count():
        tree = materialise(tree, "tree")
        branches = materialise(_branches(tree, level), "branches").toDF("of", "parent", "segment", "label", "closer")
        if branches.isEmpty():
            break
        here = F.element_at("shape", F.when(F.size("shape") > level, level + 1).otherwise(F.lit(1)))
        match = (F.col("host") == F.col("of")) & (F.col("template") == F.col("parent")) & (here == F.col("segment")) & (F.size("shape") > level)
        met = tree.join(branches, match, "left")
        tree = met.select(
            "host", "shape", "n", "good", "bad",
            F.when(F.col("label").isNull(), F.col("template")).otherwise(F.concat_ws("/", "template", "label")).alias("template"),
            F.coalesce("closer", "purity").alias("purity"),
        )
    return tree.select("host", "shape", "template", "purity")


def judge(pages: DataFrame, given: Sequence[Rule], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row (page_id, host, path, rule, verdict, template, purity) per row of ``pages``.

    The longest rule that fits decides. The pages that rules decide are the labelled ones: they teach
    the tree of their host which templates are mostly blocked, and a page without a rule is blocked if
    its template's smoothed purity is below ``PRIOR``. Where nothing is labelled, pages are allowed.
    A null address or one without ``://`` has empty host and path, and is judged as such a host.
    Ids may be null or repeat; other columns are not looked at.
    """
    host, path = parts(F.col(url).cast("string"))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    text, verdict = ruled(F.col("host"), F.col("path"), given)
    rows = rows.withColumns({"rule": text, "told": verdict})
    known = templates(rows.select("host", "path", F.col("told").alias("verdict")))
    known = materialise(known, "templates").toDF("of", "shape", "template", "purity")
    met = rows.join(known, (F.col("host") == F.col("of")) & (shape(F.col("path")) == F.col("shape")), "left")
    own = F.when(F.col("purity") < PRIOR, BLOCK).otherwise(ALLOW)
    return met.select("page_id", "host", "path", "rule", F.coalesce("told", own).alias("verdict"), "template", "purity")


def allowed(pages: DataFrame, given: Sequence[Rule], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """The pages that are allowed, all columns as they were. Pages that share an address share a verdict."""
    key = free_name(pages, "address")
    known = judge(pages, given, url, url).select(F.col("page_id").alias(key), "verdict").where(F.col("verdict") == BLOCK)
    blocked = materialise(known.select(key).distinct(), "blocked")
    return pages.join(blocked, pages[url].eqNullSafe(blocked[key]), "left_anti").select(*pages.columns)
