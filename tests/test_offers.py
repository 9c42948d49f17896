"""Envelopes over the downgrade ratio, monotone and calibrated scores, attributions."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerwise import models
from offerwise.models.tuning import OutcomeLogLoss, _cross_validated, linear_losses
from offerwise.operators import attribution
from offerwise.operators.calibrated import BINS, CalibratedScorer, Curve, addressable
from offerwise.operators.metrics import with_class_weights
from offerwise.operators.monotone import MonotoneScorer
from offerwise.operators.scenarios import GRID, at_discount, prepare_cohort
from offerwise.operators.scoring import ModelScorer, SoftmaxScorer, score_at_discounts
from offerwise.operators.value import best_offer
from offerwise.plans import training
from offerwise.plans.envelope import envelope_sensitivity, upper_envelope
from offerwise.plans.strategy import alpha_sensitivity
from offerwise.registry import inputs
from offerwise.registry.pricing_queries import CALIBRATED, _faults_of, rough_scores
from offerwise.schemas import FEATURES, PROBABILITIES

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def cohort(spark):
    return inputs.cohort(spark, SF_DIR).persist()


# --- envelopes ---------------------------------------------------------------------------


def test_envelope_is_the_greatest_line(spark):
    pick = random.Random(4)
    rows = []
    for i in range(300):
        n = pick.randint(0, 7)
        # Few distinct values, so that slopes and lines coincide and three lines meet in a point.
        rows.append((i, [(float(pick.randint(0, 3)), float(pick.randint(0, 4))) for _ in range(n)]))
    lines = spark.createDataFrame(rows, "id int, lines array<struct<slope: double, base: double>>")
    found = {r.id: r.pieces for r in lines.selectExpr("id", f"{upper_envelope('lines')} AS pieces").collect()}
    for i, given in rows:
        pieces = found[i]
        since = [p.since for p in pieces]
        assert since == sorted(set(since)) and [p.slope for p in pieces] == sorted({p.slope for p in pieces})
        for alpha in np.linspace(-2, 3, 41):
            if not given:
                assert pieces == []
                continue
            at = max(j for j, s in enumerate(since) if s <= alpha)
            assert pieces[at].base + alpha * pieces[at].slope == pytest.approx(max(b + alpha * s for s, b in given))


@pytest.mark.parametrize("probs", ["static", "rescored"])
@pytest.mark.parametrize("alphas", [(0.7,), (0.9, 0.1, 0.5, 0.1), tuple(k / 40 for k in range(60))])
def test_envelope_equals_the_direct_totals(cohort, probs, alphas):
    direct = alpha_sensitivity(cohort, inputs.SCORER, sorted(set(alphas)), probs=probs).collect()
    found = envelope_sensitivity(cohort, inputs.SCORER, alphas, probs=probs).collect()
    assert len(found) == len(direct)
    for a, b in zip(found, direct, strict=True):
        assert tuple(a) == pytest.approx(tuple(b), rel=1e-10)


def test_envelope_without_values(cohort):
    broken = cohort.withColumn("catalog_price", F.when(F.col("purchaseid") % 2 == 0, F.lit(float("nan"))))
    rows = envelope_sensitivity(broken, inputs.SCORER, (0.2, 0.8), probs="rescored").collect()
    assert [tuple(r)[1:] for r in rows] == [(0, 0, 0)] * 2
    empty = envelope_sensitivity(cohort.limit(0), inputs.SCORER, (0.2, 0.8)).collect()
    assert [tuple(r) for r in empty] == [(0.2, 0, 0, 0), (0.8, 0, 0, 0)]


def test_envelope_groups_by_alpha_only(cohort):
    plan = plan_of(envelope_sensitivity(cohort, inputs.SCORER, probs="rescored"))
    assert plan.count("Exchange hashpartitioning(at") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# --- monotone scores ---------------------------------------------------------------------


def pooled(values):
    """Adjacent violators, pooled one after the other."""
    blocks = []
    for v in values:
        blocks.append([v, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            (a, n), (b, m) = blocks[-2:]
            blocks[-2:] = [[(a * n + b * m) / (n + m), n + m]]
    return [v for v, n in blocks for _ in range(n)]


def test_pooling_equals_adjacent_violators(cohort):
    prepared = prepare_cohort(cohort)
    rough = score_at_discounts(prepared, rough_scores, GRID)
    even = score_at_discounts(prepared, MonotoneScorer(rough_scores), GRID)
    before = {r[0]: r[1:] for r in rough.df.selectExpr("purchaseid", *[p[2] for p in rough.p]).collect()}
    sums = [f"{' + '.join(p)} AS s{i}" for i, p in enumerate(even.p)]
    for row in even.df.selectExpr("purchaseid", *[p[2] for p in even.p], *sums).collect():
        churn = row[1:8]
        assert churn == pytest.approx(pooled(before[row[0]][::-1])[::-1])
        assert all(a >= b for a, b in zip(churn, churn[1:], strict=False))
        assert row[8:] == pytest.approx([1.0] * 7)


@pytest.mark.parametrize("family", ["forest", "boosted"])
def test_pooled_trees_never_fall(cohort, family):
    params = {"maxDepth": 3} | ({"numTrees": 8} if family == "forest" else {"maxIter": 4})
    model = models.fit_outcome_model(cohort, FEATURES, models.Learner(family, params=params))
    raw = score_at_discounts(prepare_cohort(cohort), models.scorer_of(model), GRID)
    even = score_at_discounts(prepare_cohort(cohort), MonotoneScorer(models.scorer_of(model)), GRID)

    def falls(scored):
        steps = [f"{scored.p[i][2]} < {scored.p[i + 1][2]}" for i in range(6)]
        return scored.df.where(" OR ".join(steps)).count()

    assert falls(raw) > 0
    assert falls(even) == 0


@pytest.mark.parametrize("family", ["forest", "boosted"])
def test_code_of_scored_trees_is_compiled(spark, cohort, family):
    """All discounts of a pipeline in one method were more than the JVM compiles."""
    params = {"maxDepth": 2} | ({"numTrees": 3} if family == "forest" else {"maxIter": 2})
    model = models.fit_outcome_model(cohort, FEATURES, models.Learner(family, params=params))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # its plans show no code before they run
    try:
        faults = _faults_of(models.scorer_of(model), cohort, family)
        explain = spark.sparkContext._jvm.PythonSQLUtils.explainString
        code = explain(faults._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert 0 < max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


@pytest.mark.parametrize("family", ["forest", "boosted"])
def test_scores_at_discounts_are_those_of_single_discounts(cohort, family):
    params = {"maxDepth": 3} | ({"numTrees": 4} if family == "forest" else {"maxIter": 3})
    model = models.fit_outcome_model(cohort, FEATURES, models.Learner(family, params=params))
    scorer = ModelScorer(model, FEATURES)
    # Scores that a cohort brings along are replaced.
    prepared = prepare_cohort(cohort).withColumns({p: F.lit(9.0) for p in PROBABILITIES})
    scored = score_at_discounts(prepared, scorer, GRID)
    assert not {*PROBABILITIES} & {*scored.df.columns}
    for i in (0, 3, 6):
        alone = scorer(at_discount(prepare_cohort(cohort), GRID[i])).select("purchaseid", *PROBABILITIES)
        assert alone.count() == cohort.count()
        assert alone.exceptAll(scored.df.selectExpr("purchaseid", *scored.p[i])).count() == 0


def test_broken_scores_stay(cohort):
    def holed(df):
        scored = rough_scores(df)
        hole = (F.col("purchaseid") % 2 == 0) & (F.col("simulated_discount") > 0.2)
        return scored.withColumn("p_churn", F.when(~hole, F.col("p_churn")))

    even = score_at_discounts(prepare_cohort(cohort), MonotoneScorer(holed), GRID)
    rows = even.df.selectExpr("purchaseid % 2 = 0 AS hole", f"{even.p[6][2]} IS NULL AS gone").distinct().collect()
    assert {tuple(r) for r in rows} == {(True, True), (False, False)}


def test_one_discount_has_no_order(cohort):
    offers = best_offer(cohort, MonotoneScorer(inputs.SCORER), grid=(0.1,))
    plain = best_offer(cohort, inputs.SCORER, grid=(0.1,))
    both = offers.join(plain.select("purchaseid", F.col("p_churn").alias("c")), "purchaseid")
    assert both.where("abs(p_churn - c) > 1e-12").count() == 0


# --- calibrated scores -------------------------------------------------------------------


@pytest.fixture(scope="module")
def calibrated(cohort):
    return models.calibrate(with_class_weights(cohort), FEATURES, training.PRODUCTION, "class_weight")


def test_addressed_curves_equal_the_pipeline(cohort, calibrated):
    scorer = models.scorer_of(calibrated)
    assert isinstance(scorer, CalibratedScorer)
    by_model = ModelScorer(calibrated, FEATURES)
    for discount in (None, 0.15):
        rows = cohort if discount is None else at_discount(prepare_cohort(cohort), discount)
        named = by_model(rows).select("purchaseid", *[F.col(p).alias(f"m_{p}") for p in PROBABILITIES])
        both = scorer(rows).join(named, "purchaseid")
        assert both.count() == cohort.count()
        assert both.where(" or ".join(f"not abs({p} - m_{p}) <= 1e-9" for p in PROBABILITIES)).count() == 0


def test_calibrated_offers_equal_the_pipeline(cohort, calibrated):
    columns = ("purchaseid", "scenario_id", "expected_value")
    fast = best_offer(cohort, models.scorer_of(calibrated)).select(*columns)
    slow = best_offer(cohort, ModelScorer(calibrated, FEATURES)).select(
        "purchaseid", F.col("scenario_id").alias("s"), F.col("expected_value").alias("v")
    )
    off = fast.join(slow, "purchaseid").where("scenario_id <> s or not abs(expected_value - v) <= 1e-6")
    assert off.count() == 0


def test_curves_at_knots_and_ends(spark):
    curve = Curve((0.0, 0.5, 0.50009, 1.0), (0.1, 0.2, 0.7, 0.9))
    below, x, y = curve.table()
    assert len(below) == BINS + 1 and below[0] == 0 and below[5000] == 1 and below[-1] == 3
    pick = np.random.default_rng(1)
    scores = np.concatenate([[0, 0.5, 0.50009, 0.500045, 1, 0.49995, 0.50005], pick.random(500)])
    for s in scores:
        k = below[int(np.floor(s * BINS + 0.5))]
        k += x[k + 1] <= s
        value = y[k] + (y[k + 1] - y[k]) * (s - x[k]) / (x[k + 1] - x[k])
        assert value == pytest.approx(np.interp(s, curve.x, curve.y))
    assert not addressable((0.1, 0.10001)) and not addressable(()) and not addressable((0.2, 0.1))
    with pytest.raises(ValueError, match="knots"):
        Curve((0.3, 0.3), (0.0, 1.0))


def test_calibrated_plan_has_no_exchange(cohort):
    plan = plan_of(best_offer(cohort, CALIBRATED))
    assert "Exchange" not in plan and "Join" not in plan


def test_steps_of_calibrated_offers_hand_on_few_values(spark, cohort):
    """The JVM leaves methods of some 70 parameters, and those that call them, half compiled."""
    scorer = CalibratedScorer(CALIBRATED.folds[:1] * 3, CALIBRATED.curves[:1] * 3)
    explain = spark._jvm.PythonSQLUtils.explainString
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for columns in (["simulated_discount"], ["purchaseid", "simulated_discount", "expected_value"]):
            offers = best_offer(cohort, scorer).select(*columns)
            code = explain(offers._jdf.queryExecution(), "codegen")
            steps = re.findall(r"void generate_doConsume_\w+\(([^)]*)\)", code)
            assert steps and max(len(step.split(",")) for step in steps) <= 55
            assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_broken_scores_stay_broken(spark, cohort, ansi):
    """NaN margins give NaN, and no curve reads the knots of the next."""
    endless = SoftmaxScorer(("arpu",), ((1e308,), (1e308,), (0.0,)), (0.0, 0.0, 0.0))
    curve = Curve((0.2, 0.7), (0.3, 0.6))
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = cohort.where("arpu > 10 and catalog_price > 0").orderBy("purchaseid").limit(5)
        broken = CalibratedScorer((endless,), ((curve,) * 3,))(rows).collect()
        assert broken and all(math.isnan(r[p]) for r in broken for p in PROBABILITIES)
        offers = best_offer(rows, CalibratedScorer((endless,), ((curve,) * 3,))).collect()
        assert all(r.scenario_id == 0 and r.expected_value is None for r in offers)
        sound = CalibratedScorer((inputs.SCORER,) * 2, ((curve,) * 3,) * 2)
        alone = CalibratedScorer((inputs.SCORER,), ((curve,) * 3,))
        both = best_offer(rows, sound).collect()
        for twice, once in zip(both, best_offer(rows, alone).collect(), strict=True):
            assert twice.expected_value == pytest.approx(once.expected_value, rel=1e-12)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_scores_that_are_all_zero_are_shared(cohort):
    flat = Curve((0.5,), (0.0,))
    scorer = CalibratedScorer((inputs.SCORER,), ((flat, flat, flat),))
    row = scorer(cohort).agg(*[F.min(p).alias(p) for p in PROBABILITIES]).first()
    assert tuple(row) == pytest.approx((1 / 3, 1 / 3, 1 / 3))


# --- batched evaluation ------------------------------------------------------------------


def test_linear_candidates_are_judged_in_one_pass(spark, cohort):
    learner = models.Learner()
    names = models.fitting.model_inputs(FEATURES)
    with models.fitting.training_vectors(cohort, FEATURES) as vectors:
        fitted = [
            models.Learner(params={"regParam": r, "maxIter": 20}).classifiers(names)[0].fit(vectors)
            for r in (0.001, 0.1, 10.0)
        ]
        one_by_one = [OutcomeLogLoss().evaluate(m.transform(vectors)) for m in fitted]
        entries = [f"x{j}" for j in range(len(names))]
        scorers = [models.fitting.softmax_scorer(m, entries) for m in fitted]
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("judging", "")
        together = linear_losses(vectors, scorers)
        jobs = tracker.getJobIdsForGroup("judging")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert together == pytest.approx(one_by_one, rel=1e-9)
    # An aggregate is a job for each of its stages.
    assert len(jobs) <= 2
    assert learner.family == "logistic"


@pytest.mark.parametrize("family", ["logistic", "forest"])
def test_search_losses_follow_their_settings(cohort, family):
    learner = models.Learner(family, params={"numTrees": 3} if family == "forest" else {})
    space = {"maxDepth": [1, 4]} if family == "forest" else {"regParam": [0.001, 100.0]}
    best, results = models.tune(cohort, FEATURES, learner, space=space, draws=2, folds=2)
    by_setting = {next(iter(s.values())): loss for s, loss in results}
    assert by_setting[4 if family == "forest" else 0.001] < by_setting[1 if family == "forest" else 100.0]
    assert best.params | min(results, key=lambda r: r[1])[0] == best.params
    assert _cross_validated  # judged per fold


# --- attributions ------------------------------------------------------------------------


def test_parts_add_up_to_the_margins(cohort):
    scorer = models.scorer_of(models.fit_outcome_model(cohort, FEATURES, training.PRODUCTION))
    means = attribution.input_means(cohort, scorer)
    base = attribution.mean_margins(scorer, means)
    parts = attribution.attributions(cohort, scorer, means)
    sums = {r[0]: r[1:] for r in parts.groupBy("purchaseid").sum("accept", "downgrade", "churn").collect()}
    for row in scorer(cohort).select("purchaseid", *PROBABILITIES).collect():
        margins = [b + s for b, s in zip(base, sums[row[0]], strict=True)]
        odds = np.exp(np.array(margins) - max(margins))
        assert odds / odds.sum() == pytest.approx(row[1:], abs=1e-7)


def test_mean_customer_has_no_parts(spark):
    scorer = SoftmaxScorer(("arpu", "gap_days", "gap_days_missing"), ((0, 0, 0), (1, 2, 3), (4, 5, -6)), (0, 0, 0))
    rows = spark.createDataFrame([(1, 2.0, None), (2, 4.0, 3)], "purchaseid int, arpu double, gap_days int")
    means = attribution.input_means(rows, scorer)
    assert means == {"arpu": 3.0, "gap_days": 1.5, "gap_days_missing": 0.5}
    parts = {(r.purchaseid, r.feature): r for r in attribution.attributions(rows, scorer, means).collect()}
    assert parts[1, "arpu"].churn == -4 and parts[1, "gap_days"].value is None
    assert parts[1, "gap_days"].churn == 5 * -1.5 + -6 * 0.5
    found = attribution.reasons(rows, scorer, means, top=1).collect()
    assert [tuple(r) for r in found] == [(1, []), (2, ["gap_days"])]
    assert attribution.input_means(rows.limit(0), scorer) == dict.fromkeys(scorer.features, 0.0)


def test_attributions_are_narrow(cohort):
    means = dict.fromkeys(inputs.SCORER.features, 0.0)
    for df in (attribution.attributions(cohort, inputs.SCORER, means), attribution.reasons(cohort, inputs.SCORER, means)):
        assert "Exchange" not in plan_of(df)
