"""Nearest of many fixed points by a grid over them: a row is compared with the few points its cell leaves."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tripworks.functions.numeric import array_constant

# Steps of an axis; the lines of the grid lie on them.
STEPS = 4096
# Cells per centre, about, and the most lines of an axis.
CELLS_PER_CENTRE = 8
MOST_LINES = 128
# The outermost cells go on for so many times the centres' own extent; rows beyond are compared with all.
MARGIN = 1000.0


@dataclass
class Axis:
    """Lines across one coordinate, closer where the centres are; cells on both ends go on to ``low`` and ``high``."""

    start: float
    step: float
    lines: np.ndarray
    low: float
    high: float

    @classmethod
    def over(cls, values: np.ndarray, lines: int) -> Axis:
        start, end = float(values.min()), float(values.max())
        extent = max(end - start, 1e-9)
        step = extent / STEPS
        wanted = np.quantile(np.unique(values), np.linspace(0, 1, lines))
        at = np.unique(np.rint((wanted - start) / step).astype(int))
        return cls(start, step, at[(at > 0) & (at < STEPS)], start - MARGIN * extent, end + MARGIN * extent)

    def cell_of_step(self) -> list[int]:
        """Cell of each step."""
        return np.searchsorted(self.lines, np.arange(STEPS), "right").tolist()

    def bounds(self) -> np.ndarray:
        """Edges of the cells, a little apart from where rounding could put a value."""
        return np.concatenate([[self.low], self.start + self.lines * self.step, [self.high]])

    def cell(self, value: Column, table: Column) -> Column:
        step = F.floor((value - F.lit(self.start)) / F.lit(self.step)).cast("int")
        return F.element_at(table, F.least(F.greatest(step, F.lit(0)), F.lit(STEPS - 1)) + 1)

    def inside(self, value: Column) -> Column:
        return (value >= F.lit(self.low)) & (value <= F.lit(self.high))


def _undominated(centres: np.ndarray, corners: np.ndarray) -> np.ndarray:
    """Centres that may be nearest somewhere in the box of these corners.

    How much nearer one centre is than another, by squared distance, is linear in the place, so it
    suffices to look at the corners. One that is farther than some other at all of them, by more than
    rounding can make up for, is nearest nowhere; of equal ones the first stays.
    """
    near = ((centres[:, None, :] - corners[None, :, :]) ** 2).sum(axis=2)
    # only those can be nearest that are not farther everywhere than some centre is anywhere
    slack = 1e-9 * (1 + near.max())
    middle = (corners.min(axis=0) + corners.max(axis=0)) / 2
    outside = np.maximum(np.abs(centres - middle) - (corners.max(axis=0) - corners.min(axis=0)) / 2, 0)
    some = np.flatnonzero((outside**2).sum(axis=1) <= near.max(axis=1).min() + slack)
    gap = near[some][:, None, :] - near[some][None, :, :]
    scale = near[some].max(axis=0) + 1
    worse = (gap > 1e-12 * scale).all(axis=2)
    equal = (centres[some][:, None, :] == centres[some][None, :, :]).all(axis=2) & (some[:, None] > some[None, :])
    return some[~(worse | equal).any(axis=1)]


class CentreIndex:
    """Cells of a grid over the centres, each with the centres that may be nearest to a point in it."""

    def __init__(self, centres: Sequence[Sequence[float]]):
        self.centres = np.asarray(centres, dtype=np.float64).reshape(-1, 2)
        lines = int(min(MOST_LINES, max(2, np.ceil(np.sqrt(CELLS_PER_CENTRE * len(self.centres))))))
        self.axes = [Axis.over(self.centres[:, k], lines) for k in (0, 1)]
        bounds = [a.bounds() for a in self.axes]
        # a value on a line may round to either side of it
        reach = [1e-6 * a.step for a in self.axes]
        lists = []
        for i in range(len(bounds[0]) - 1):
            for j in range(len(bounds[1]) - 1):
                corners = np.array(
                    [(x, y) for x in (bounds[0][i] - reach[0], bounds[0][i + 1] + reach[0]) for y in (bounds[1][j] - reach[1], bounds[1][j + 1] + reach[1])]
                )
                lists.append(_undominated(self.centres, corners))
        self.most = max(map(len, lists))
        # shorter lists repeat their first centre, which changes nothing
        self.lists = np.array([np.concatenate([x, np.repeat(x[:1], self.most - len(x))]) for x in lists])

    @property
    def columns(self) -> int:
        return len(self.axes[1].lines) + 1

    def mean_candidates(self) -> float:
        """Different centres per cell, on average."""
        return float(np.mean([len(set(x)) for x in self.lists.tolist()]))

    def assign(self, df: DataFrame, ends: dict[str, tuple[Column, Column]]) -> DataFrame:
        """Add, per name, the number of the nearest centre of a point; the first of equally near ones, NULL without a point."""
        tables = [array_constant(a.cell_of_step(), "int") for a in self.axes]
        lat, lng, number = (
            array_constant(values, kind)
            for values, kind in (
                (self.centres[self.lists, 0].ravel().tolist(), "double"),
                (self.centres[self.lists, 1].ravel().tolist(), "double"),
                (self.lists.ravel().tolist(), "int"),
            )
        )
        places = {}
        for name, (y, x) in ends.items():
            cell = self.axes[0].cell(y, tables[0]) * self.columns + self.axes[1].cell(x, tables[1])
            places[f"__at_{name}"] = F.when(self.axes[0].inside(y) & self.axes[1].inside(x), cell * self.most)
        out = df.withColumns(places)
        found = {}
        for name, (y, x) in ends.items():
            at = F.col(f"__at_{name}")
            each = []
            for k in range(1, self.most + 1):
                dy, dx = y - F.element_at(lat, at + k), x - F.element_at(lng, at + k)
                each.append(F.struct((dy * dy + dx * dx).alias("d"), F.element_at(number, at + k).alias("n")))
            best = (F.least(*each) if len(each) > 1 else each[0])["n"]
            whole = F.when(y.isNotNull() & x.isNotNull(), compared_with_all(y, x, self.centres.tolist()))
            found[name] = F.when(at.isNotNull(), best).otherwise(whole)
        return out.withColumns(found).drop(*places)


def compared_with_all(lat: Column, lng: Column, centres: Sequence[Sequence[float]]) -> Column:
    """Number of the nearest of all centres, for the few points far outside of them."""
    ys, xs = (array_constant([c[k] for c in centres], "double") for k in (0, 1))
    distances = F.zip_with(ys, xs, lambda y, x: (lat - y) * (lat - y) + (lng - x) * (lng - x))
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")
