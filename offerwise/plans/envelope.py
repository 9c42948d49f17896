"""Portfolio value as a function of the downgrade ratio, for any number of ratios at once.

An offer is worth p_accept * offer + alpha * p_downgrade * offer: a line in alpha. The best
offer of a customer is the upper envelope of a line per discount, convex and of as many pieces
at most. Only where it bends does the portfolio's total change its slope, so the total over all
alphas follows from the bends, summed by the first alpha behind each: one aggregate of as many
groups as there are alphas, whose running sums are the total's intercept and slope.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerwise.functions import number
from offerwise.operators.scenarios import GRID, prepare_cohort
from offerwise.operators.scoring import Scorer, in_between, score_at_discounts
from offerwise.plans.strategy import ALPHAS, FLAT_DISCOUNT, is_on_grid
from offerwise.schemas import PROBABILITIES

_PIECES = "array<struct<slope: double, base: double, since: double>>"
_ALWAYS = "double('-Infinity')"


def _overtakes(old: str, new: str) -> str:
    """From which alpha on a line of greater or equal slope is worth more than `old`."""
    return (
        f"if({new}.slope > {old}.slope, ({old}.base - {new}.base) / ({new}.slope - {old}.slope),"
        f" {_ALWAYS})"
    )


def upper_envelope(lines: str) -> str:
    """SQL of the pieces (slope, base, since) of the envelope of `lines` (slope, base), by alpha.

    Lines come in order of slope. A new one takes over from those whose own piece would begin
    behind the point where it overtakes them; on a convex envelope these are the last ones.
    """
    kept = f"filter(pieces, old -> old.since < {_overtakes('old', 'line')})"
    since = f"if(size(kept) = 0, {_ALWAYS}, {_overtakes('element_at(kept, -1)', 'line')})"
    extended = f"concat(kept, array(struct(line.slope AS slope, line.base AS base, {since} AS since)))"
    # transform() over an array of one names the kept pieces.
    step = f"transform(array({kept}), kept -> {extended})[0]"
    return f"aggregate(array_sort({lines}), cast(array() AS {_PIECES}), (pieces, line) -> {step})"


def _first_at(since: str, alphas: Sequence[float]) -> str:
    """SQL of the number of `alphas` (ascending, in the column _alphas) below `since`, by bisection."""
    steps = [1 << b for b in reversed(range(len(alphas).bit_length()))]
    return (
        f"aggregate(array({', '.join(map(str, steps))}), 0, (at, step) ->"
        f" if(coalesce(get(_alphas, at + step - 1) < {since}, false), at + step, at))"
    )


def envelope_sensitivity(
    portfolio: DataFrame,
    scorer: Scorer,
    alphas: Sequence[float] = ALPHAS,
    grid: Sequence[float] = GRID,
    flat: float = FLAT_DISCOUNT,
    probs: str = "static",
) -> DataFrame:
    """`alpha_sensitivity` with the same result, at a cost that hardly depends on the alphas.

    A row contributes once for each piece of its envelope. NaN and NULL values never win; a
    customer without any value adds nothing.
    """
    alphas = sorted({float(a) for a in alphas})
    offered = len(grid)
    if not any(is_on_grid(d, flat) for d in grid):
        grid = (*grid, flat)
    flat_at = next(i for i, d in enumerate(grid) if is_on_grid(d, flat))
    none_at = next((i for i, d in enumerate(grid) if d == 0.0), None)
    prepared = prepare_cohort(portfolio.drop(*PROBABILITIES))
    scored = score_at_discounts(prepared, scorer, grid, probs)
    parts, names = [], []
    for i, (discount, (p_accept, p_downgrade, _)) in enumerate(zip(grid, scored.p, strict=True)):
        offer = f"(catalog_price * (1 - {number(discount)}))"
        parts += [f"nullif({p} * {offer}, double('NaN'))" for p in (p_accept, p_downgrade)]
        names += [f"_accept_{i}", f"_downgrade_{i}"]
    valued = in_between(scored.df, names, parts)

    def line(i: int | None) -> str:
        if i is None:
            return "cast(null AS struct<slope: double, base: double>)"
        return f"struct(_downgrade_{i} AS slope, _accept_{i} AS base)"

    lines = ", ".join(line(i) for i in range(offered))
    known = f"filter(array({lines}), line -> line.slope + line.base IS NOT NULL)"
    values = f"cast(array({', '.join(map(number, alphas))}) AS array<double>)"
    bent = in_between(
        valued,
        ["_pieces", "_flat", "_none", "_alphas"],
        [upper_envelope(known), line(flat_at), line(none_at), values],
    ).select("_pieces", "_flat", "_none", "_alphas")

    # What each piece adds to the one before it, and the two fixed offers with the first alpha.
    change = "piece.{0} - coalesce(get(_pieces, i - 1).{0}, 0D)"
    pieces = (
        f"transform(_pieces, (piece, i) -> struct({_first_at('piece.since', alphas)} AS at,"
        f" {change.format('base')} AS base, {change.format('slope')} AS slope,"
        " 0D AS flat_base, 0D AS flat_slope, 0D AS none_base, 0D AS none_slope))"
    )
    fixed = ["0 AS at", "0D AS base", "0D AS slope"]
    for kind in ("flat", "none"):
        whole = f"_{kind}.slope + _{kind}.base IS NOT NULL"
        fixed += [f"if({whole}, _{kind}.{part}, 0D) AS {kind}_{part}" for part in ("base", "slope")]
    changes = bent.selectExpr(f"inline(concat({pieces}, array(struct({', '.join(fixed)}))))")
    sums = [c for c in changes.columns if c != "at"]
    by_alpha = (
        changes.where(F.col("at") < len(alphas)).groupBy("at").agg(*[F.sum(c).alias(c) for c in sums])
    )

    # A row per alpha: one task holds them all.
    points = bent.sparkSession.range(0, len(alphas), numPartitions=1).selectExpr(
        "cast(id AS int) AS at", f"get({values}, cast(id AS int)) AS alpha"
    )
    so_far = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    totals = points.join(by_alpha, "at", "left").withColumns(
        {c: F.coalesce(F.sum(c).over(so_far), F.lit(0.0)) for c in sums}
    )
    return totals.selectExpr(
        "alpha",
        "base + alpha * slope AS dynamic_value",
        "flat_base + alpha * flat_slope AS flat_value",
        "none_base + alpha * none_slope AS undiscounted_value",
    ).orderBy("alpha")
