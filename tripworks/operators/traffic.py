"""Counts of trips in a time window around each trip."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripworks.functions.calendar import MICROS_PER_MINUTE, epoch_micros
from tripworks.operators.joins import attach


@dataclass(frozen=True)
class Span:
    """Window from ``first`` to ``last`` microseconds relative to a row's time, both included."""

    first: int
    last: int

    @staticmethod
    def after(minutes: int) -> Span:
        """Strictly after the row and strictly within the minutes."""
        return Span(1, minutes * MICROS_PER_MINUTE - 1)

    @staticmethod
    def before(minutes: int) -> Span:
        return Span(1 - minutes * MICROS_PER_MINUTE, -1)

    @staticmethod
    def trailing(minutes: int) -> Span:
        """The row's own time included, the far end left out."""
        return Span(1 - minutes * MICROS_PER_MINUTE, 0)


_CELL = 1_000_000  # one second of microseconds


def with_window_counts(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    spans: Mapping[str, Span],
    spread: str = "id",
    source: DataFrame | None = None,
) -> DataFrame:
    """Add for each span how many rows with equal ``keys`` fall into it; 0 if time or key is missing.

    Rows are counted per key and moment first, so copies of one moment never meet in a task; the
    moments are counted against each other within cells of time, so no key is sorted as a whole; and
    the counts go back to the rows by key and moment, heavy moments in slices.

    ``source`` may give the same rows with fewer columns and a shorter plan to count from.
    """
    moments, counted = window_counts(source or df, ts, keys, spans)
    joined = attach(
        df.withColumn("_micros", epoch_micros(F.col(ts))), counted, [*keys, "_micros"], spread=spread, key_counts=moments
    )
    return joined.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in spans}).drop("_micros")


def window_counts(
    rows: DataFrame, ts: str, keys: Sequence[str], spans: Mapping[str, Span]
) -> tuple[DataFrame, DataFrame]:
    """Rows per key and moment (``_rows``), and the spans' counts per key and moment (``_micros``)."""
    if any(s.first > s.last or s.first < 0 < s.last for s in spans.values()):
        raise ValueError("a span must be ordered and lie on one side of the row")
    present = F.col("_micros").isNotNull()
    for key in keys:
        present = present & F.col(key).isNotNull()
    placed = rows.select(*keys, epoch_micros(F.col(ts)).alias("_micros")).where(present)
    moments = placed.groupBy(*keys, "_micros").agg(F.count(F.lit(1)).alias("_rows"))
    return moments, _count_by_cell(moments, "_micros", list(keys), spans)


def _floor_div(value: Column, by: int) -> Column:
    """Whole division towards minus infinity without a detour over inexact quotients."""
    return ((value - F.pmod(value, F.lit(by))) / F.lit(by)).cast("bigint")


def _width(spans: Mapping[str, Span]) -> int:
    return max(max(abs(s.first), abs(s.last)) for s in spans.values()) + 1


@dataclass(frozen=True)
class _Edge:
    """A moment ``offset`` microseconds from the row, where a span begins or has just ended."""

    offset: int

    @property
    def reach(self) -> int:
        return self.offset // _CELL

    @property
    def steps(self) -> tuple[int, ...]:
        """Cells beyond ``reach`` the edge may lie in, as the row's place in its own cell decides."""
        return (0, 1) if self.offset % _CELL else (0,)

    def step(self, off: Column) -> Column:
        return (off + self.offset % _CELL >= _CELL).cast("int")


def _count_by_cell(moments: DataFrame, at: str, keys: list[str], spans: Mapping[str, Span]) -> DataFrame:
    """Counts per key and moment; no task holds more than the microseconds of one second.

    Time is cut into cells of a second. What lies in a span is what lies before its end less what
    lies before its beginning. Whole cells between the two edges are added up from one total per
    cell. For the rest, a moment sends a probe to the cell of each edge that lies inside one, where a running
    sum tells how much of the cell lies before it, and the answers are summed when they come back.
    """
    placed = moments.withColumns({"_cell": _floor_div(F.col(at), _CELL), "_off": F.pmod(at, F.lit(_CELL))})
    edges = {name: (_Edge(s.first), _Edge(s.last + 1)) for name, s in spans.items()}

    # whole cells from the one the beginning lies in to the one before the end's, for either place
    whole = {
        f"{name}_{i}{j}": Span(near.reach + i, far.reach + j - 1)
        for name, (near, far) in edges.items()
        for i in near.steps
        for j in far.steps
    }
    cells = placed.groupBy(*keys, "_cell").agg(F.sum("_rows").alias("_rows"))
    middles = _count_cells(cells, keys, whole)

    offsets = sorted({edge.offset for pair in edges.values() for edge in pair})
    probes = [F.struct(F.lit(o).alias("_probe"), (F.col(at) + o).alias("_place"), F.lit(0).alias("_weight")) for o in offsets]
    itself = F.struct(F.lit(None).cast("bigint").alias("_probe"), F.col(at).alias("_place"), F.col("_rows").alias("_weight"))
    laid = placed.select(*keys, at, F.inline(F.array(itself, *probes)))
    laid = laid.withColumns({"_cell": _floor_div(F.col("_place"), _CELL), "_off": F.pmod("_place", F.lit(_CELL))})
    before = Window.partitionBy(*keys, "_cell").orderBy("_off").rangeBetween(Window.unboundedPreceding, -1)
    # nothing lies before the start of a cell, so whole seconds need no probe
    asked = laid.where(F.col("_probe").isNull() | (F.col("_off") > 0))
    read = asked.withColumn("_under", F.coalesce(F.sum("_weight").over(before), F.lit(0)))
    answers = []
    for name, (near, far) in edges.items():
        part = F.when(F.col("_probe") == far.offset, F.col("_under")).otherwise(0)
        answers.append(F.sum(part - F.when(F.col("_probe") == near.offset, F.col("_under")).otherwise(0)).alias(f"_edge_{name}"))
    edge_sums = read.groupBy(*keys, at).agg(*answers)
    located = edge_sums.withColumns({"_cell": _floor_div(F.col(at), _CELL), "_off": F.pmod(at, F.lit(_CELL))})

    def middle(name: str) -> Column:
        near, far = edges[name]
        value = None
        for i in near.steps:
            for j in far.steps:
                here = F.col(f"_mid_{name}_{i}{j}")
                match = (near.step(F.col("_off")) == i) & (far.step(F.col("_off")) == j)
                value = here if value is None else F.when(match, here).otherwise(value)
        return value

    return located.join(middles, [*keys, "_cell"]).select(
        *keys, at, *((F.col(f"_edge_{n}") + middle(n)).alias(n) for n in spans)
    )


def _count_cells(cells: DataFrame, keys: list[str], whole: Mapping[str, Span]) -> DataFrame:
    """Sums of whole cells from ``first`` to ``last`` cells away; an empty range sums to 0."""
    width = _width(whole)
    steps = sorted({step for s in whole.values() for step in ((-1,) if s.last > 0 else ()) + ((1,) if s.first < 0 else ())})
    home = _floor_div(F.col("_cell"), width)
    laid = cells.withColumn("_home", home).withColumn(
        "_bucket", F.explode(F.array(F.col("_home"), *(F.col("_home") + step for step in steps)))
    )
    # Running sums are carried from cell to cell; a frame with two moving ends would be added up anew for each.
    within = Window.partitionBy(*keys, "_bucket").orderBy("_cell")

    def up_to(step: int) -> Column:
        return F.coalesce(F.sum("_rows").over(within.rangeBetween(Window.unboundedPreceding, step)), F.lit(0))

    sums = [
        (up_to(s.last) - up_to(s.first - 1) if s.first <= s.last else F.lit(0)).alias(f"_mid_{name}") for name, s in whole.items()
    ]
    return laid.select(*keys, "_cell", "_bucket", "_home", *sums).where(F.col("_bucket") == F.col("_home")).drop("_bucket", "_home")


def with_pickup_traffic(
    df: DataFrame,
    minutes: Sequence[int] = (10, 15),
    cluster: str = "pickup_kmeans_100_cluster",
    source: DataFrame | None = None,
) -> DataFrame:
    """Pickups in the trip's pickup cluster in the minutes after it started."""
    spans = {f"this_{cluster}after_{m}minutes_traffic": Span.after(m) for m in minutes}
    return with_window_counts(df, "pickup_datetime", [cluster], spans, source=source)


def with_dropoff_traffic(
    df: DataFrame,
    minutes: Sequence[int] = (10, 15),
    cluster: str = "dropoff_kmeans_100_cluster",
    direction: str = "after",
    source: DataFrame | None = None,
) -> DataFrame:
    """Dropoffs in the trip's dropoff cluster in the minutes after (or before) it ended."""
    side = {"after": Span.after, "before": Span.before}[direction]
    spans = {f"this_{cluster}pre_{m}minutes_traffic": side(m) for m in minutes}
    return with_window_counts(df, "dropoff_datetime", [cluster], spans, source=source)


def with_trailing_count(
    df: DataFrame, ts: str = "pickup_datetime", minutes: int = 60, name: str = "count_60min", spread: str = "id"
) -> DataFrame:
    """Rows in the trailing window ending at each row, rows of the same moment included."""
    return with_window_counts(df, ts, [], {name: Span.trailing(minutes)}, spread)
