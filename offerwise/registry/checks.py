"""Registered jobs whose results show in SQL whether a fit, a guard or a reader is right.

Models are fitted on a feature for which the fit has a closed form, or what they must hold
to is counted.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwise.functions import arithmetic_bucket, even_grid
from offerwise.models import (
    Learner,
    calibrate,
    churn_risk,
    fit_churn_model,
    fit_outcome_model,
    load_model,
    publish,
    save_model,
    scorer_of,
    tune,
)
from offerwise.models.tuning import SEARCH_SPACE
from offerwise.operators import metrics, splits
from offerwise.operators.calibrated import CalibratedScorer
from offerwise.operators.scoring import ModelScorer, hard_prediction
from offerwise.plans import audit, external, strategy, training
from offerwise.plans.mart import stage_purchases
from offerwise.registry import inputs
from offerwise.registry.inputs import SCORER
from offerwise.schemas import FEATURES, LABEL, OUTCOMES, PRICE_FEATURES, PROBABILITIES
from offerwise.session import scratch_path
from offerwise.sources import tables
from offerwise.sources.purchases import purchases_from_orders, read_purchases

CHECKS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# One binary feature and no shrinkage: the likeliest probabilities are shares of rows.
GROUP = "has_static_ip"
EXACT = {"regParam": 0.0, "tol": 1e-12, "maxIter": 300}


def check(function):
    CHECKS[function.__name__] = function
    return function


def _shares(spark, sf_dir, learner: Learner, weight: str | None = None) -> DataFrame:
    """Probabilities by value of the only feature."""
    rows = inputs.cohort(spark, sf_dir)
    if weight:
        rows = metrics.with_class_weights(rows)
    scored = scorer_of(fit_outcome_model(rows, [GROUP], learner, weight))(rows)
    return scored.groupBy(GROUP).agg(*[F.round(F.avg(p), 3).alias(p) for p in PROBABILITIES])


@check
def q_logistic_shares(spark, sf_dir):
    return _shares(spark, sf_dir, Learner(params=EXACT))


@check
def q_weighted_shares(spark, sf_dir):
    return _shares(spark, sf_dir, Learner(params=EXACT), "class_weight")


@check
def q_forest_shares(spark, sf_dir):
    """One split; Spark takes it back where both sides predict the same outcome."""
    stump = {"numTrees": 1, "maxDepth": 1, "featureSubsetStrategy": "all", "bootstrap": False}
    return _shares(spark, sf_dir, Learner("forest", params=stump))


@check
def q_boosted_shares(spark, sf_dir):
    return _shares(spark, sf_dir, Learner("boosted", params={"maxIter": 1, "maxDepth": 1}))


@check
def q_boosted_default_shares(spark, sf_dir):
    """All default boosting steps."""
    return _shares(spark, sf_dir, Learner("boosted"))


@check
def q_calibrated_shares(spark, sf_dir):
    """Cross-fitted shares, put in order by the isotonic fits and averaged."""
    rows = inputs.cohort(spark, sf_dir)
    model = calibrate(rows, [GROUP], Learner(params=EXACT), bucket=arithmetic_bucket)
    scored = scorer_of(model)(rows)
    return scored.groupBy(GROUP).agg(*[F.round(F.avg(p), 3).alias(p) for p in PROBABILITIES])


@check
def q_boosted_churn_shares(spark, sf_dir):
    rows = inputs.cohort(spark, sf_dir)
    scored = churn_risk(fit_churn_model(rows, [GROUP]), rows)
    return scored.groupBy(GROUP).agg(F.round(F.avg("churn_risk"), 3).alias("churn_risk"))


@check
def q_churn_shares(spark, sf_dir):
    rows = inputs.cohort(spark, sf_dir)
    scored = churn_risk(fit_churn_model(rows, [GROUP], "logistic", **EXACT), rows)
    return scored.groupBy(GROUP).agg(F.round(F.avg("churn_risk"), 3).alias("churn_risk"))


def _faults(model, rows: DataFrame) -> DataFrame:
    """Rows scored, and how often a price-constrained model breaks what it must hold to."""
    scorer = scorer_of(model)
    linear = model.stages[-1]
    assert isinstance(linear, LogisticRegressionModel)
    wrong = 0
    for name, *weights in zip(scorer.features, *scorer.coefficients, strict=True):
        if name in PRICE_FEATURES:
            wrong += sum(w > 1e-9 if k != 2 else w < -1e-9 for k, w in zip(OUTCOMES, weights, strict=True))
    total = reduce(lambda a, b: a + b, [F.col(p) for p in PROBABILITIES])
    counted = scorer(rows).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~(F.abs(total - 1) < 1e-9)).alias("sums_off_one"),
    )
    steps = []
    for feature in PRICE_FEATURES:
        curve = audit.partial_dependence(rows, {feature: scorer}, feature, even_grid(0.0, 20000.0, 11))
        steps.append(audit.falling_steps(curve))
    falls = reduce(DataFrame.unionByName, steps).agg(F.sum("falling_steps").alias("falling_steps"))
    return counted.withColumns(
        {"wrong_signs": F.lit(wrong), "falling_steps": F.lit(falls.first()[0]).cast("bigint")}
    )


@check
def q_constrained_faults(spark, sf_dir):
    rows = metrics.with_class_weights(inputs.cohort(spark, sf_dir))
    return _faults(fit_outcome_model(rows, FEATURES, training.PRODUCTION, "class_weight"), rows)


@check
def q_retrained_faults(spark, sf_dir):
    model = training.retrain(inputs.mart(spark, sf_dir), scratch_path(spark, "retrained"))
    return _faults(model, inputs.cohort(spark, sf_dir))


@check
def q_audit_faults(spark, sf_dir):
    curve = audit.constraint_audit(inputs.mart(spark, sf_dir))
    constrained = audit.falling_steps(curve.where("model = 'constrained'"))
    return constrained.select("model", "falling_steps")


@check
def q_saved_model_faults(spark, sf_dir):
    """Rows whose probabilities differ after a model was saved and loaded."""
    rows = inputs.cohort(spark, sf_dir)
    path = scratch_path(spark, "saved")
    model = fit_outcome_model(rows, FEATURES, Learner("forest", params={"numTrees": 5}))
    save_model(model, path)
    renamed = {p: f"before_{p}" for p in PROBABILITIES}
    before = scorer_of(model)(rows).withColumnsRenamed(renamed)
    both = scorer_of(load_model(path))(before)
    same = reduce(
        lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(renamed[p])) for p in PROBABILITIES]
    )
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~same).alias("differing"))


def _differing(rows: DataFrame, before, after, bound: float = 0.0) -> DataFrame:
    """Rows, and those to which two scorers give probabilities further apart than `bound`."""
    renamed = {p: f"before_{p}" for p in PROBABILITIES}
    both = after(before(rows).withColumnsRenamed(renamed))
    same = reduce(
        lambda a, b: a & b, [F.abs(F.col(p) - F.col(renamed[p])) <= bound for p in PROBABILITIES]
    )
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.coalesce(same, F.lit(False))).alias("differing"))


@check
def q_calibrated_faults(spark, sf_dir):
    """Rows that column code with addressed curves scores unlike the pipeline itself."""
    rows = inputs.cohort(spark, sf_dir)
    model = calibrate(metrics.with_class_weights(rows), FEATURES, training.PRODUCTION, "class_weight")
    by_columns = scorer_of(model)
    assert isinstance(by_columns, CalibratedScorer)
    return _differing(rows, ModelScorer(model, FEATURES), by_columns, 1e-9)


@check
def q_saved_calibrated_faults(spark, sf_dir):
    """Rows whose probabilities differ after a calibrated model was published and loaded."""
    rows = inputs.cohort(spark, sf_dir)
    path = scratch_path(spark, "published")
    model = calibrate(metrics.with_class_weights(rows), FEATURES, training.PRODUCTION, "class_weight")
    publish(spark, model, path)
    return _differing(rows, scorer_of(model), scorer_of(load_model(path)))


@check
def q_search_faults(spark, sf_dir):
    rows = inputs.cohort(spark, sf_dir)
    best, results = tune(rows, FEATURES)
    space = SEARCH_SPACE["logistic"]
    drawn = {tuple(sorted(s.items())) for s, _ in results}
    outside = sum(v not in space[k] for s, _ in results for k, v in s.items())
    least = min(loss for _, loss in results)
    chosen = next(loss for s, loss in results if s.items() <= best.params.items())
    row = (len(results), len(drawn), outside, int(chosen > least))
    return spark.createDataFrame(
        [row], "draws int, distinct_draws int, outside_space int, better_than_chosen int"
    ).join(rows.agg(F.count(F.lit(1)).alias("rows")), F.lit(True))


@check
def q_train_faults(spark, sf_dir):
    """A full training run: settings drawn, a better one than that chosen, and averages of the
    report that do not follow from its classes."""
    run = inputs.training_run(spark, sf_dir)
    report = {r["class"]: r for r in run.report.collect()}
    classes = [report[c] for c in metrics.OUTCOME_NAMES]
    total = sum(r.support for r in classes)
    off = 0
    for name in ("precision", "recall", "f1"):
        off += abs(report["macro avg"][name] - sum(r[name] for r in classes) / 3) > 1e-9
        weighted = sum(r[name] * r.support for r in classes) / total
        off += abs(report["weighted avg"][name] - weighted) > 1e-9
    off += abs(report["accuracy"].recall - report["weighted avg"].recall) > 1e-9
    least = min(loss for _, loss in run.search)
    chosen = next(loss for s, loss in run.search if s.items() <= run.learner.params.items())
    counted = inputs.cohort(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"))
    return counted.withColumns(
        {
            "draws": F.lit(len(run.search)),
            "better_than_chosen": F.lit(int(chosen > least)),
            "averages_off": F.lit(int(off)),
            "supports_off": F.lit(int(total != report["accuracy"].support)),
        }
    )


@check
def q_train_supports(spark, sf_dir):
    """Unseen rows of each outcome in the report of a full training run."""
    report = inputs.training_run(spark, sf_dir).report
    return report.where(F.col("class").isin(*metrics.OUTCOME_NAMES)).select("class", "support")


@check
def q_ablation_faults(spark, sf_dir):
    """Models compared, and gains that do not follow from their metrics."""
    rows = {r["model"]: r for r in training.ablation(inputs.mart(spark, sf_dir)).collect()}
    base, more = rows["baseline"], rows["enhanced"]
    f1 = (more.macro_f1 - base.macro_f1) / base.macro_f1 * 100
    loss = (base.log_loss - more.log_loss) / base.log_loss * 100
    off = int(abs(f1 - more.f1_gain_percent) > 1e-6) + int(abs(loss - more.loss_gain_percent) > 1e-6)
    counted = inputs.cohort(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"))
    return counted.withColumns({"models": F.lit(len(rows)), "gains_off": F.lit(off)})


@check
def q_sample_digest(spark, sf_dir):
    """How a sample of any key is drawn: by digest, which every engine has."""
    return splits.sample_rows(inputs.cohort(spark, sf_dir), 500).select("purchaseid", LABEL)


# --- other data ------------------------------------------------------------------------


@check
def q_external_noise(spark, sf_dir):
    adapted = external.adapt_external(inputs.churn_export(spark, sf_dir))
    return adapted.select("customerID", F.round("arpu_trend", 6).alias("arpu_trend"))


@check
def q_external_policy_fixed(spark, sf_dir):
    adapted = external.adapt_external(inputs.churn_export(spark, sf_dir))
    return external.external_policy(adapted.withColumn("arpu_trend", F.lit(0.0)), SCORER, "rescored")


@check
def q_external_encode_wide(spark, sf_dir):
    """A text column with a value for each row."""
    named = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return external.encode_text(named)


# --- readers and guards ----------------------------------------------------------------


@check
def q_read_purchases(spark, sf_dir):
    path = scratch_path(spark, "purchase-log")
    log = inputs.raw_purchases(spark, sf_dir).withColumn("note", F.lit("x"))
    log.withColumn("price", F.col("price").cast("string")).write.parquet(path)
    staged = stage_purchases(read_purchases(spark, path), inputs.STATIC_IP)
    return staged.withColumn("price", F.col("price").cast("double"))


@check
def q_staging_missing_parts(spark, sf_dir):
    """Part keys that are frequent and NULL, or that no part has."""
    orders, lineitem, part = (inputs.table(spark, sf_dir, n) for n in inputs.PURCHASE_TABLES)
    third = F.col("l_orderkey") % 3
    broken = F.when(third == 0, F.lit(None)).when(third == 1, F.lit(-1)).otherwise(F.col("l_partkey"))
    lineitem = lineitem.withColumn("l_partkey", broken.cast("bigint"))
    limit = 1 + lineitem.count() // 100
    log = purchases_from_orders(orders, lineitem, part, hot_part_lines=limit)
    return log.select("purchaseid", "productname", "bandwidth", "gig_product", "flowcount")


@check
def q_cohort_csv_minimum(spark, sf_dir):
    """A cohort file with the five required columns only, in another order."""
    path = scratch_path(spark, "cohort-minimum")
    columns = ["duration", "username", "arpu_trend", "arpu", "catalog_price"]
    inputs.cohort(spark, sf_dir).select(*columns).write.option("header", True).csv(path)
    numbered = tables.with_row_id(tables.read_cohort_csv(spark, path))
    return numbered.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("purchaseid").alias("row_ids"),
        F.round(F.sum("arpu"), 2).alias("arpu"),
        F.round(F.sum("arpu_trend"), 2).alias("arpu_trend"),
        F.round(F.sum("catalog_price"), 2).alias("catalog_price"),
        F.sum("duration").alias("duration"),
        F.count_distinct("username").alias("usernames"),
    )


@check
def q_mart_csv_optional_columns(spark, sf_dir):
    """A feature file with the optional columns and one more, in another order."""
    path = scratch_path(spark, "mart-optional")
    mart = inputs.mart(spark, sf_dir)
    wider = mart.withColumns(
        {
            "province": F.concat(F.lit("p"), F.col("username") % 5),
            "salesagent": F.lit("a"),
            "actual_paid_price": F.col("catalog_price").cast("decimal(18,2)"),
            "note": F.lit("n"),
        }
    )
    wider.select(*sorted(wider.columns)).write.option("header", True).csv(path)
    read = tables.read_features_csv(spark, path)
    return read.select(
        F.col("purchaseid").cast("bigint").alias("purchaseid"),
        "province",
        "salesagent",
        F.col("actual_paid_price").cast("double").alias("actual_paid_price"),
        "note",
        "catalog_price",
        LABEL,
        "gap_days",
    )


@check
def q_scores_missing_feature(spark, sf_dir):
    """A cohort that lacks a feature of the model: it counts as 0."""
    scored = SCORER(inputs.cohort(spark, sf_dir).drop("arpu_trend"))
    return scored.select("purchaseid", *[F.round(p, 6).alias(p) for p in PROBABILITIES])


@check
def q_alpha_sensitivity_off_grid(spark, sf_dir):
    """A flat discount that value maximisation does not offer."""
    totals = strategy.alpha_sensitivity(inputs.cohort(spark, sf_dir), SCORER, flat=0.12, probs="rescored")
    return totals.select(
        "alpha", *[F.round(c, 2).alias(c) for c in ("dynamic_value", "flat_value", "undiscounted_value")]
    )


@check
def q_metrics_with_gaps(spark, sf_dir):
    """Scores with NULL labels (every 7th row), and NaN or NULL probabilities (some of those
    whose id is odd): their loss is NULL, their prediction too."""
    key = F.col("purchaseid")
    odd = key % 2 == 1
    holes = F.when(odd & (key % 5 == 0), F.lit(float("nan"))).when(odd & (key % 11 == 0), F.lit(None))
    broken = odd & ((key % 5 == 0) | (key % 11 == 0))
    scored = SCORER(inputs.cohort(spark, sf_dir)).withColumns(
        {
            LABEL: F.when(key % 7 != 0, F.col(LABEL)),
            **{p: F.when(broken, holes.cast("double")).otherwise(F.col(p)) for p in PROBABILITIES},
        }
    )
    weighted = metrics.with_class_weights(scored).withColumn("guess", hard_prediction())
    return weighted.groupBy(odd.alias("odd")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(metrics.log_loss(F.col(LABEL)), 6).alias("log_loss"),
        F.count("guess").alias("predicted"),
        F.count("class_weight").alias("weighted"),
        F.round(F.sum("class_weight"), 4).alias("weight"),
    )
