"""Calibrated probabilities as column code: every curve is a table addressed by the score.

A calibration curve has at most one knot in each bin of scores (see `models.calibration`), so
the number of knots below a score is that below its bin, which a table holds for every bin, and
one comparison. No curve is searched. The tables are one small row that the plan reads once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerwise.functions import number, softmax
from offerwise.operators.scoring import Scenarios, SoftmaxScorer, choice_of, in_between
from offerwise.schemas import PROBABILITIES

# Bins of scores from 0 to 1, and the outcomes.
BINS = 10_000
OUTCOMES = range(3)

_AXES = {
    "_below": T.ArrayType(T.IntegerType(), False),
    "_knot_x": T.ArrayType(T.DoubleType(), False),
    "_knot_y": T.ArrayType(T.DoubleType(), False),
}
_TABLES = T.StructType().add(
    "curves", T.StructType([T.StructField(n, t, False) for n, t in _AXES.items()]), False
)


def _bins(x: Sequence[float]) -> np.ndarray:
    return np.floor(np.asarray(x, float) * BINS + 0.5)


def addressable(x: Sequence[float]) -> bool:
    """Whether knots ascend from 0 to 1, at most one in each bin of scores."""
    bins = _bins(x)
    return len(bins) > 0 and bool((np.diff(bins) > 0).all() and bins[0] >= 0 and bins[-1] <= BINS)


@dataclass(frozen=True)
class Curve:
    """A line through knots (x, y), x ascending, level before the first and after the last."""

    x: tuple[float, ...]
    y: tuple[float, ...]

    def __post_init__(self) -> None:
        if not addressable(self.x):
            raise ValueError("knots must ascend from 0 to 1, at most one in each bin of scores")

    def table(self) -> tuple[list[int], list[float], list[float]]:
        """Knots before each bin, and the knots with a level one at either end."""
        below = np.searchsorted(_bins(self.x), np.arange(BINS + 1), "left")
        x = [self.x[0] - 1, *self.x, self.x[-1] + 1]
        return below.tolist(), x, [self.y[0], *self.y, self.y[-1]]


@dataclass(frozen=True)
class CalibratedScorer:
    """The mean of the folds' calibrated probabilities, from softmax models and their curves.

    `curves` holds, for each fold, a curve per outcome. Calibrated scores are normalised over
    the outcomes; where all are 0, each gets an equal share.
    """

    folds: tuple[SoftmaxScorer, ...]
    curves: tuple[tuple[Curve, ...], ...]

    @property
    def features(self) -> tuple[str, ...]:
        return self.folds[0].features

    def __call__(self, df: DataFrame) -> DataFrame:
        kept = [f"`{c}`" for c in df.columns if c not in PROBABILITIES]
        df = df.select(*kept)
        for f, fold in enumerate(self.folds):
            names = [f"_score_{f * len(OUTCOMES) + k}" for k in OUTCOMES]
            df = fold(df).withColumnsRenamed(dict(zip(PROBABILITIES, names, strict=True)))
        df = self._calibrated(self._with_curves(df), "_means")
        return df.selectExpr(*kept, *[f"_means[{k}] AS {p}" for k, p in enumerate(PROBABILITIES)])

    def at_discounts(self, df: DataFrame, grid: Sequence[float]) -> Scenarios:
        given = [f"`{c}`" for c in df.columns]
        ends = []
        for f, fold in enumerate(self.folds):
            df = fold.ends(df, f"_{f}_")
            ends += [f"_{f}_{end}_{k}" for k in OUTCOMES for end in ("full", "free")]
        df = self._with_curves(df.select(*given, F.array(*ends).alias("_ends")))
        kept = [f"`{c}`" for c in df.columns]
        cells = range(len(OUTCOMES) * len(self.folds))
        for i, discount in enumerate(grid):
            margins = [
                f"_ends[{2 * c}] + {number(discount)} * (_ends[{2 * c + 1}] - _ends[{2 * c}])"
                for c in cells
            ]
            df = in_between(df, [f"_margin_{c}" for c in cells], margins)
            shares = []
            for f in range(len(self.folds)):
                shares += softmax([f"_margin_{f * len(OUTCOMES) + k}" for k in OUTCOMES])
            df = in_between(df, [f"_score_{c}" for c in cells], shares)
            df = self._calibrated(df, f"_means_{i}")
            df = df.select(*kept, *[f"_means_{j}" for j in range(i + 1)])
        means = [f"_means_{i}" for i in range(len(grid))]
        columns = [tuple(f"{m}[{k}]" for k in OUTCOMES) for m in means]
        return Scenarios(df.select(*given, *means), columns, choice_of(columns))

    def _with_curves(self, df: DataFrame) -> DataFrame:
        """Add the tables of all curves, one after another: `_below` leads to `_knot_x`, `_knot_y`."""
        below, x, y = [], [], []
        for curve in (curve for fold in self.curves for curve in fold):
            own_below, own_x, own_y = curve.table()
            below += [len(x) + n for n in own_below]
            x += own_x
            y += own_y
        tables = df.sparkSession.createDataFrame([((below, x, y),)], _TABLES).scalar()
        # Not NULL, which the plan cannot know of a subquery: half as much is passed between steps.
        named = {n: F.coalesce(tables[n], F.array().cast(t)) for n, t in _AXES.items()}
        return df.withColumns(named)

    def _calibrated(self, df: DataFrame, name: str) -> DataFrame:
        """Add the array `name` of mean probabilities, from `_score_0` and so on, fold by fold.

        In steps of code small enough to compile, which hand on few values: the JVM leaves
        methods of some 70 parameters to its weaker compiler, and so those that call them.
        What only the next steps read is no array, since reading one takes longer.
        """
        flat = range(len(OUTCOMES) * len(self.folds))
        below = [
            f"_below[{c * (BINS + 1)} + cast(floor(_score_{c} * {BINS} + 0.5D) AS int)]" for c in flat
        ]
        df = in_between(df, [f"_before_{c}" for c in flat], below)
        at = [f"_before_{c} + if(_knot_x[_before_{c} + 1] <= _score_{c}, 1, 0)" for c in flat]
        df = in_between(df, [f"_at_{c}" for c in flat], at)
        for f in range(len(self.folds)):
            values = []
            for k in OUTCOMES:
                c = f * len(OUTCOMES) + k
                x, y = (f"_knot_{axis}[_at_{c}{{}}]" for axis in "xy")
                rise = f"({y.format(' + 1')} - {y.format('')})"
                along = f"(_score_{c} - {x.format('')}) / ({x.format(' + 1')} - {x.format('')})"
                values.append(f"{y.format('')} + {rise} * {along}")
            df = in_between(df, [f"_value_{f}_{k}" for k in OUTCOMES], values)
        means = []
        for k in OUTCOMES:
            shares = []
            for f in range(len(self.folds)):
                total = "(" + " + ".join(f"_value_{f}_{j}" for j in OUTCOMES) + ")"
                shares.append(f"if({total} > 0, _value_{f}_{k} / {total}, {number(1 / len(OUTCOMES))})")
            means.append(f"({' + '.join(shares)}) / {len(self.folds)}")
        return in_between(df, [name], [f"array({', '.join(means)})"])


__all__ = ["BINS", "CalibratedScorer", "Curve", "addressable"]
