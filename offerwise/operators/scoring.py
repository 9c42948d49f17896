"""Outcome probabilities of a row, from a fitted model or from known coefficients."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerwise.functions import number, softmax
from offerwise.operators.scenarios import REPRICED, align_features, at_discount
from offerwise.schemas import PROBABILITIES

MISSING = "_missing"

# A scorer adds p_accept, p_downgrade and p_churn to each row, row by row.
Scorer = Callable[[DataFrame], DataFrame]


def model_input(feature: str) -> str:
    """SQL of a feature as models read it: NULL and NaN become 0, '<f>_missing' flags them."""
    source = f"nullif(cast(`{feature.removesuffix(MISSING)}` as double), double('NaN'))"
    if feature.endswith(MISSING):
        return f"cast({source} IS NULL as double)"
    return f"coalesce({source}, 0D)"


@dataclass(frozen=True)
class SoftmaxScorer:
    """Softmax over linear margins, as plain column arithmetic.

    Keeps scoring inside the generated code of the surrounding stage. Each of
    the three classes has one coefficient per feature and an intercept.
    """

    features: tuple[str, ...]
    coefficients: tuple[tuple[float, ...], ...]
    intercepts: tuple[float, ...]

    def __call__(self, df: DataFrame) -> DataFrame:
        df = self._with_inputs(df, self.features)
        margins = self._margins([number(b) for b in self.intercepts], self.features)
        names = _names("_margin")
        df = in_between(df, names, margins).drop(*self._input_names(self.features))
        return df.selectExpr("*", *_as_probabilities(softmax(names))).drop(*names)

    def at_discounts(self, df: DataFrame, grid: Sequence[float]) -> Scenarios:
        """Probabilities at every discount from two evaluations of the margins.

        All repriced features are linear in the discount, and so are the margins.
        """
        changing = [f for f in self.features if f in REPRICED]
        settled = [f for f in self.features if f not in REPRICED]
        df = self._with_inputs(df, settled)
        fixed = self._margins([number(b) for b in self.intercepts], settled)
        df = in_between(df, _names("_fixed"), fixed).drop(*self._input_names(settled))
        for name, discount in (("_full", 0.0), ("_free", 1.0)):
            df = self._with_inputs(at_discount(df, discount), changing)
            margins = self._margins(_names("_fixed"), changing)
            df = in_between(df, _names(name), margins).drop(*self._input_names(changing))

        def p_at(discount: str) -> list[str]:
            return softmax(
                [f"(_full_{k} + {discount} * (_free_{k} - _full_{k}))" for k in range(3)]
            )

        return Scenarios(
            df,
            [tuple(p_at(number(d))) for d in grid],
            lambda scenario, discount: p_at(discount),
        )

    def ends(self, df: DataFrame, prefix: str) -> DataFrame:
        """Add the margins at no discount and at one of 100 %, as <prefix>full_k and <prefix>free_k:
        between them margins are linear in the discount."""
        df = self.at_discounts(df, ()).df.drop(*_names("_fixed"))
        return df.withColumnsRenamed(
            {n: f"{prefix}{n[1:]}" for n in (*_names("_full"), *_names("_free"))}
        )

    def _input_names(self, features: Sequence[str]) -> list[str]:
        return [f"_in_{self.features.index(f)}" for f in features]

    def _with_inputs(self, df: DataFrame, features: Sequence[str]) -> DataFrame:
        """Add clean, never-NULL inputs, read by all three margins."""
        if not features:
            return df
        df = align_features(df, [f.removesuffix(MISSING) for f in features])
        named = zip(self._input_names(features), features, strict=True)
        return df.withColumns({name: F.expr(model_input(f)) for name, f in named})

    def _margins(self, start: Sequence[str], features: Sequence[str]) -> list[str]:
        """`start` plus the weighted inputs of `features`, per class."""
        margins = []
        for margin, weights in zip(start, self.coefficients, strict=True):
            weight_of = dict(zip(self.features, weights, strict=True))
            terms = [
                f"{number(weight_of[f])} * {name}"
                for f, name in zip(features, self._input_names(features), strict=True)
                if weight_of[f]
            ]
            margins.append(" + ".join([margin, *terms]))
        return margins


@dataclass(frozen=True)
class Scenarios:
    """A cohort scored at several discounts, side by side.

    p: SQL of the three probabilities, per scenario.
    p_chosen: their SQL at one scenario per row, given the names of the
    columns that hold its number and its discount.
    """

    df: DataFrame
    p: list[tuple[str, ...]]
    p_chosen: Callable[[str, str], list[str]]


def with_given(
    df: DataFrame, scorers: Sequence[SoftmaxScorer], names: Sequence[str], label: str = "label"
) -> DataFrame:
    """Add what each scorer gives the row's label; all have the same features.

    Each scorer is a step of its own, so that its code stays small enough to be compiled.
    """
    features = scorers[0].features
    kept = list(df.columns)
    df = scorers[0]._with_inputs(df, features)
    inputs = scorers[0]._input_names(features)
    for scorer, name in zip(scorers, names, strict=True):
        margins = _names("_margin")
        start = [number(b) for b in scorer.intercepts]
        df = in_between(df, margins, scorer._margins(start, features))
        cases = " ".join(f"WHEN {k} THEN {p}" for k, p in enumerate(softmax(margins)))
        df = in_between(df, [name], [f"CASE cast(`{label}` AS int) {cases} END"]).drop(*margins)
    return df.select(*kept, *names).drop(*inputs)


def _as_probabilities(p: Sequence[str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in zip(PROBABILITIES, p, strict=True)]


def _names(prefix: str) -> list[str]:
    return [f"{prefix}_{k}" for k in range(3)]


def in_between(df: DataFrame, names: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Add columns through a generator of one row.

    A filter on what is computed from them is then not pushed down into copies
    of all their terms, and the generated code before and after it goes into
    methods of their own. The JVM does not compile methods over 8000 bytes.
    """
    generator = f"inline(array(struct({', '.join(columns)})))"
    return df.selectExpr("*", f"{generator} AS ({', '.join(names)})")


@dataclass(frozen=True)
class ModelScorer:
    """Scores with a fitted Spark ML pipeline (see `offerwise.models`)."""

    model: Model
    features: tuple[str, ...]

    def __call__(self, df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c not in PROBABILITIES]
        scored = self.model.transform(align_features(df.select(*kept), self.features))
        return with_probabilities(scored).select(*kept, *PROBABILITIES)

    def at_discounts(self, df: DataFrame, grid: Sequence[float]) -> Scenarios:
        """Each discount is code of its own, which two generators in a row cut off: in one method
        the pipelines of all discounts are more than the JVM compiles."""
        given = [f"`{c}`" for c in df.columns if c not in PROBABILITIES]
        columns = []
        for i, discount in enumerate(grid):
            df = self(at_discount(df, discount))
            columns.append(tuple(f"{p}_{i}" for p in PROBABILITIES))
            scored = [f"_{p}_{i}" for p in PROBABILITIES]
            df = in_between(in_between(df, scored, PROBABILITIES), columns[-1], scored)
            df = df.select(*given, *[p for triple in columns for p in triple])
        return Scenarios(df, columns, choice_of(columns))


def score_at_discounts(
    df: DataFrame, scorer: Scorer, grid: Sequence[float], probs: str = "rescored"
) -> Scenarios:
    """Score a prepared cohort at every discount, or with probs='static' once, as it is."""
    if probs == "static":
        return Scenarios(scorer(df), [PROBABILITIES] * len(grid), lambda *_: list(PROBABILITIES))
    if probs != "rescored":
        raise ValueError(f"probs must be 'static' or 'rescored', not {probs!r}")
    if hasattr(scorer, "at_discounts"):
        return scorer.at_discounts(df, grid)
    for i, discount in enumerate(grid):
        df = scorer(at_discount(df, discount))
        df = df.withColumnsRenamed({p: f"{p}_{i}" for p in PROBABILITIES})
    columns = [tuple(f"{p}_{i}" for p in PROBABILITIES) for i in range(len(grid))]
    return Scenarios(df, columns, choice_of(columns))


def choice_of(columns: Sequence[tuple[str, ...]]) -> Callable[[str, str], list[str]]:
    """`Scenarios.p_chosen` where the probabilities of every scenario are columns."""

    def p_chosen(scenario: str, discount: str) -> list[str]:
        chosen = []
        for k in range(len(PROBABILITIES)):
            cases = " ".join(f"WHEN {i} THEN {c[k]}" for i, c in enumerate(columns))
            chosen.append(f"CASE {scenario} {cases} END")
        return chosen

    return p_chosen


def with_probabilities(scored: DataFrame) -> DataFrame:
    """Turn whatever a pipeline left behind into three probability columns."""
    if PROBABILITIES[0] in scored.columns:
        return scored
    if "probability" in scored.columns:
        parts = scored.withColumn("_p", vector_to_array("probability"))
        shares = [F.get("_p", F.lit(k)) for k in range(3)]
    else:  # one classifier per class against the rest
        parts = scored.withColumns(
            {f"_p{k}": F.get(vector_to_array(f"probability_{k}"), F.lit(1)) for k in range(3)}
        )
        shares = _normalised([F.col(f"_p{k}") for k in range(3)])
    named = dict(zip(PROBABILITIES, shares, strict=True))
    return parts.withColumns(named).drop("_p", "_p0", "_p1", "_p2")


def _normalised(parts: Sequence[Column]) -> list[Column]:
    total = sum(parts[1:], parts[0])
    return [F.when(total > 0, p / total).otherwise(1.0 / len(parts)) for p in parts]


def hard_prediction() -> Column:
    """The likeliest outcome; the first one among equals. NULL if a probability is NULL or NaN."""
    p0, p1, p2 = (F.col(p) for p in PROBABILITIES)
    broken = [p.isNull() | F.isnan(p) for p in (p0, p1, p2)]
    return (
        F.when(broken[0] | broken[1] | broken[2], F.lit(None).cast("int"))
        .when((p0 >= p1) & (p0 >= p2), 0)
        .when(p1 >= p2, 1)
        .otherwise(2)
    )
