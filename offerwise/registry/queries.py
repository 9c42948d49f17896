"""Registered jobs: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerwise.functions import arithmetic_bucket, even_grid, is_close
from offerwise.operators import metrics, splits
from offerwise.operators.catalog import HOT_CELL_ROWS, with_catalog_price
from offerwise.operators.history import CHUNK_ROWS, HOT_USER_ROWS, with_history
from offerwise.operators.labels import customer_action
from offerwise.operators.scenarios import expand_scenarios
from offerwise.operators.scoring import hard_prediction
from offerwise.operators.value import best_offer, optimal_discount, with_expected_value
from offerwise.plans import audit, external, mart as mart_plan, prescription, strategy, training
from offerwise.plans.incremental import append_batch, incremental_mart
from offerwise.registry import inputs
from offerwise.registry.checks import CHECKS
from offerwise.registry.inputs import SCORER
from offerwise.registry.model_queries import MODEL_QUERIES
from offerwise.registry.pricing_queries import PRICING
from offerwise.schemas import FEATURES, LABEL, PROBABILITIES, cohort_schema
from offerwise.session import scratch_path
from offerwise.sources import tables
from offerwise.sources.purchases import HOT_PART_LINES, purchases_from_orders, read_purchases
from offerwise.sources.quarantine import read_checked_cohort

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = ["username", "purchaseid"]
COHORT = ["purchaseid", *cohort_schema().names]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


def probabilities(df: DataFrame) -> DataFrame:
    return rounded(df, **{p: 6 for p in PROBABILITIES})


def fraction(df: DataFrame, parts: int, limit: int) -> int:
    """A part of the rows, so that the ways for skewed data are also taken on small tables."""
    return min(limit, 1 + df.count() // parts)


# --- purchase log and mart -------------------------------------------------------------


@query
def q_staging(spark, sf_dir):
    staged = mart_plan.stage_purchases(inputs.raw_purchases(spark, sf_dir), inputs.STATIC_IP)
    return staged.withColumn("price", F.col("price").cast("double"))


@query
def q_staging_hot_parts(spark, sf_dir):
    """The way taken when some parts are on very many lines."""
    orders, lineitem, part = (inputs.table(spark, sf_dir, n) for n in inputs.PURCHASE_TABLES)
    limit = fraction(lineitem, 1700, HOT_PART_LINES)
    log = purchases_from_orders(orders, lineitem, part, hot_part_lines=limit)
    staged = mart_plan.stage_purchases(log, inputs.STATIC_IP)
    return staged.withColumn("price", F.col("price").cast("double"))


def _catalog(spark, sf_dir, **limits):
    priced = with_catalog_price(inputs.staged(spark, sf_dir), **limits)
    return priced.select(*KEY, F.col("catalog_price").cast("double").alias("catalog_price"))


@query
def q_catalog_price(spark, sf_dir):
    return _catalog(spark, sf_dir)


@query
def q_catalog_price_many_cells(spark, sf_dir):
    """The way taken when the cells are too many to broadcast."""
    limit = fraction(inputs.purchases(spark, sf_dir), 1500, HOT_CELL_ROWS)
    return _catalog(spark, sf_dir, broadcast_cells=100, hot_cell_rows=limit)


def _history(spark, sf_dir):
    return with_history(inputs.staged(spark, sf_dir))


@query
def q_purchase_sequence_ltv(spark, sf_dir):
    return _history(spark, sf_dir).select(
        *KEY, "purchase_sequence", F.col("cumulative_ltv").cast("double").alias("cumulative_ltv")
    )


@query
def q_lead_lag(spark, sf_dir):
    return _history(spark, sf_dir).select(
        *KEY,
        "next_purchasedate",
        F.col("next_price").cast("double").alias("next_price"),
        "next_duration",
        F.col("prev_price").cast("double").alias("prev_price"),
        "prev_duration",
        "prev_expirationdate",
        "prev_supportcallcount",
    )


@query
def q_gap_days(spark, sf_dir):
    trended = mart_plan.with_trends(mart_plan.with_arpu(_history(spark, sf_dir)))
    return trended.select(*KEY, "gap_days", "supportcallcount_trend")


@query
def q_rolling_disruptions(spark, sf_dir):
    return _history(spark, sf_dir).select(*KEY, "rolling_3_disruptioncount")


@query
def q_hidden_discount(spark, sf_dir):
    priced = with_catalog_price(inputs.staged(spark, sf_dir))
    return mart_plan.with_hidden_discount(priced).select(
        *KEY, "hidden_discount_amount", "hidden_discount_percentage"
    )


@query
def q_arpu_trend(spark, sf_dir):
    trended = mart_plan.with_trends(mart_plan.with_arpu(_history(spark, sf_dir)))
    return trended.select(*KEY, "arpu", "arpu_trend")


@query
def q_customer_action(spark, sf_dir):
    labelled = _history(spark, sf_dir).withColumn(LABEL, customer_action(inputs.AS_OF))
    return labelled.select(*KEY, LABEL)


@query
def q_mart(spark, sf_dir):
    return inputs.built_mart(spark, sf_dir)


@query
def q_mart_split_history(spark, sf_dir):
    """The mart with large customers' histories split into chunks."""
    log = inputs.purchases(spark, sf_dir)
    return inputs.built_mart(
        spark,
        sf_dir,
        hot_user_rows=fraction(log, 1200, HOT_USER_ROWS),
        chunk_rows=fraction(log, 30, CHUNK_ROWS),
    )


@query
def q_mart_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "mart-roundtrip")
    tables.write_mart(inputs.built_mart(spark, sf_dir), path)
    return tables.read_mart(spark, path).drop("purchase_month")


@query
def q_mart_incremental(spark, sf_dir):
    """The mart grown month by month over the last quarter. Some purchases come a month late,
    some of each month before."""
    root = scratch_path(spark, "growing-mart")
    log = inputs.purchases(spark, sf_dir)
    months = ["2001-05-01", "2001-06-01", "2001-07-01"]
    number = F.lit(0)
    for first in months:
        number = number + (F.col("purchasedate") >= F.lit(first).cast("date")).cast("int")
    delay = F.when(F.col("purchaseid") % 13 == 0, 1).when(F.col("purchaseid") % 101 == 0, 3).otherwise(0)
    arrived = log.withColumn("arrival", F.least(number + delay, F.lit(len(months))))
    for i, as_of in enumerate([*months, inputs.AS_OF]):
        batch = arrived.where(F.col("arrival") == i).drop("arrival")
        append_batch(batch, root, as_of, static_ip_pattern=inputs.STATIC_IP)
    return incremental_mart(spark, root)


@query
def q_history_bucketed(spark, sf_dir):
    """Purchase history from a table bucketed by customer."""
    path = scratch_path(spark, "bucketed-log")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    log = tables.save_by_customer(inputs.staged(spark, sf_dir), name, 8, path)
    return with_history(log).select(
        *KEY, "purchase_sequence", F.col("cumulative_ltv").cast("double").alias("cumulative_ltv")
    )


@query
def q_mart_bucketed(spark, sf_dir):
    path = scratch_path(spark, "bucketed-purchases")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    tables.save_by_customer(inputs.purchases(spark, sf_dir), name, 8, path)
    log = read_purchases(spark, name, "table")
    return mart_plan.build_mart(log, inputs.AS_OF, static_ip_pattern=inputs.STATIC_IP)


@query
def q_mart_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "mart-csv")
    tables.write_features_csv(inputs.mart(spark, sf_dir), path)
    return tables.read_features_csv(spark, path, key=T.LongType())


# --- training input --------------------------------------------------------------------


@query
def q_training_set(spark, sf_dir):
    return training.training_set(inputs.mart(spark, sf_dir), keep=("purchaseid",))


@query
def q_class_distribution(spark, sf_dir):
    return rounded(training.class_distribution(inputs.mart(spark, sf_dir)), share_percent=6)


@query
def q_class_weights(spark, sf_dir):
    weighted = metrics.with_class_weights(inputs.cohort(spark, sf_dir))
    return rounded(weighted.select("purchaseid", LABEL, "class_weight"), class_weight=9)


@query
def q_profile_counts(spark, sf_dir):
    return training.shape(training.training_set(inputs.mart(spark, sf_dir)))


@query
def q_binary_label(spark, sf_dir):
    return inputs.cohort(spark, sf_dir).select(
        "purchaseid", strategy.is_churn().alias("churned")
    )


@query
def q_split_bucket(spark, sf_dir):
    train, test = splits.split(inputs.cohort(spark, sf_dir), bucket=arithmetic_bucket)

    def side(df: DataFrame, in_train: bool) -> DataFrame:
        return df.select("purchaseid", LABEL, F.lit(in_train).alias("in_train"))

    return side(train, True).unionByName(side(test, False))


@query
def q_stratified_split(spark, sf_dir):
    placed = splits.stratified_split(
        inputs.cohort(spark, sf_dir), LABEL, bucket=arithmetic_bucket
    )
    return placed.select("purchaseid", LABEL, "in_train")


@query
def q_sample(spark, sf_dir):
    return splits.sample_rows(inputs.cohort(spark, sf_dir), 2000)


# --- prescription ----------------------------------------------------------------------


@query
def q_cohort_csv(spark, sf_dir):
    path = scratch_path(spark, "cohort-csv")
    columns = COHORT
    written = inputs.cohort(spark, sf_dir).select(*columns)
    written.write.option("header", True).csv(path)
    return tables.read_cohort_csv(spark, path, written.schema)


def _broken_cohort(spark, sf_dir):
    """A cohort file with rows that do not fit, some for two reasons."""
    path = scratch_path(spark, "broken-cohort")
    key = F.col("purchaseid")
    text = {c: F.col(c).cast("string") for c in COHORT}
    text["arpu"] = F.when(key % 10 == 0, "n/a").otherwise(text["arpu"])
    text["username"] = F.when(key % 14 == 1, F.lit(None)).otherwise(text["username"])
    text["catalog_price"] = F.when(key % 15 == 2, "-1").otherwise(text["catalog_price"])
    written = inputs.cohort(spark, sf_dir).select(*[text[c].alias(c) for c in COHORT])
    written.write.option("header", True).csv(path)
    return read_checked_cohort(spark, path, inputs.cohort(spark, sf_dir).select(*COHORT).schema)


@query
def q_quarantine_counts(spark, sf_dir):
    """Rows of a cohort file by what is wrong with them, and whether files and rows are told."""
    checked = _broken_cohort(spark, sf_dir)
    good, bad = (scratch_path(spark, n) for n in ("good-rows", "bad-rows"))
    checked.write(good, bad)
    told = F.col("file").isNotNull() & (F.length("line") > 10)
    wrong = spark.read.parquet(bad).groupBy("reason").agg(
        F.count("*").alias("rows"), F.count_if(told).alias("told")
    )
    right = spark.read.parquet(good).agg(F.count("*").alias("rows"))
    return wrong.unionByName(
        right.select(F.lit("none").alias("reason"), "rows", F.col("rows").alias("told"))
    )


@query
def q_quarantine_good(spark, sf_dir):
    return _broken_cohort(spark, sf_dir).good


@query
def q_scenarios(spark, sf_dir):
    return expand_scenarios(inputs.cohort(spark, sf_dir)).select(
        "purchaseid",
        "scenario_id",
        "simulated_discount",
        "offered_price",
        "hidden_discount_amount",
        "hidden_discount_percentage",
        "arpu",
        "arpu_trend",
    )


def _scored(spark, sf_dir):
    return prescription.scored_scenarios(inputs.cohort(spark, sf_dir), SCORER)


@query
def q_scores(spark, sf_dir):
    scored = _scored(spark, sf_dir).select("purchaseid", "scenario_id", *PROBABILITIES)
    return probabilities(scored)


@query
def q_expected_value(spark, sf_dir):
    valued = _scored(spark, sf_dir).select("purchaseid", "scenario_id", "expected_value")
    return rounded(valued, expected_value=2)


@query
def q_flat_discount(spark, sf_dir):
    """Portfolio value of single scenarios: 0 % by exact and 15 % by approximate match."""
    scenario = F.when(F.col("scenario_id") == 0, "none").otherwise("flat")
    chosen = is_close(F.col("simulated_discount"), 0.15) | (F.col("scenario_id") == 0)
    return (
        _scored(spark, sf_dir)
        .where(chosen)
        .groupBy(scenario.alias("scenario"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.round(F.sum("expected_value"), 2).alias("total_value"),
        )
    )


def _offer_columns(offers: DataFrame) -> DataFrame:
    chosen = offers.select(
        "purchaseid",
        F.col("scenario_id").cast("int").alias("scenario_id"),
        "simulated_discount",
        "offered_price",
        "arpu",
        "expected_value",
    )
    return rounded(chosen, expected_value=2)


@query
def q_optimal_discount(spark, sf_dir):
    # Only what is asked for goes through the sort and the shuffle, a row per discount.
    offers = ("purchaseid", "scenario_id", "simulated_discount", "offered_price", "arpu", "expected_value")
    return _offer_columns(optimal_discount(_scored(spark, sf_dir).select(*offers), "purchaseid"))


def _offers(spark, sf_dir):
    return best_offer(inputs.cohort(spark, sf_dir), SCORER)


@query
def q_optimal_discount_unrolled(spark, sf_dir):
    return _offer_columns(_offers(spark, sf_dir))


@query
def q_discount_distribution(spark, sf_dir):
    distribution = prescription.discount_distribution(_offers(spark, sf_dir))
    return rounded(distribution, share_percent=6)


@query
def q_target_list(spark, sf_dir):
    return prescription.target_list(_offers(spark, sf_dir))


@query
def q_target_list_csv(spark, sf_dir):
    path = scratch_path(spark, "targets-csv")
    targets = prescription.target_list(_offers(spark, sf_dir))
    tables.write_target_list(targets, path)
    return spark.read.schema(targets.schema).option("header", True).csv(path)


@query
def q_target_preview(spark, sf_dir):
    return prescription.preview(prescription.target_list(_offers(spark, sf_dir)))


@query
def q_ev_curve(spark, sf_dir):
    curve = prescription.ev_curve(inputs.cohort(spark, sf_dir), SCORER)
    return rounded(curve, expected_value=2)


# --- policies --------------------------------------------------------------------------


def _comparison(spark, sf_dir, probs):
    compared = strategy.strategy_comparison(inputs.cohort(spark, sf_dir), SCORER, probs=probs)
    return rounded(compared, threshold_rate=6, value_rate=6, value_mean_discount=6)


@query
def q_strategy_comparison(spark, sf_dir):
    return _comparison(spark, sf_dir, "static")


@query
def q_strategy_comparison_rescored(spark, sf_dir):
    return _comparison(spark, sf_dir, "rescored")


def _sensitivity(spark, sf_dir, probs):
    totals = strategy.alpha_sensitivity(inputs.cohort(spark, sf_dir), SCORER, probs=probs)
    return rounded(totals, dynamic_value=2, flat_value=2, undiscounted_value=2)


@query
def q_alpha_sensitivity_static(spark, sf_dir):
    return _sensitivity(spark, sf_dir, "static")


@query
def q_alpha_sensitivity_rescored(spark, sf_dir):
    return _sensitivity(spark, sf_dir, "rescored")


def _elasticity(spark, sf_dir, quoted):
    curve = strategy.elasticity_curve(
        training.training_set(inputs.mart(spark, sf_dir)),
        SCORER,
        worst=("rolling_3_disruptioncount",),
        quoted=quoted,
    )
    return probabilities(rounded(curve, expected_value=2))


@query
def q_elasticity_curve(spark, sf_dir):
    return _elasticity(spark, sf_dir, quoted=False)


@query
def q_elasticity_curve_quoted(spark, sf_dir):
    return _elasticity(spark, sf_dir, quoted=True)


@query
def q_mean_profile(spark, sf_dir):
    profile = strategy.mean_profile(
        training.training_set(inputs.mart(spark, sf_dir)), worst=("rolling_3_disruptioncount",)
    )
    return profile.select(*[F.round(c, 4).alias(c) for c in FEATURES])


# --- model quality ---------------------------------------------------------------------


def _predicted(spark, sf_dir):
    return SCORER(inputs.cohort(spark, sf_dir)).withColumn("prediction", hard_prediction())


@query
def q_hard_predictions(spark, sf_dir):
    return _predicted(spark, sf_dir).select("purchaseid", LABEL, "prediction")


@query
def q_confusion(spark, sf_dir):
    return metrics.confusion(_predicted(spark, sf_dir))


@query
def q_class_report(spark, sf_dir):
    report = metrics.class_report(_predicted(spark, sf_dir))
    return rounded(report, precision=6, recall=6, f1=6)


@query
def q_log_loss(spark, sf_dir):
    return _predicted(spark, sf_dir).agg(
        F.round(metrics.log_loss(F.col(LABEL)), 6).alias("log_loss"),
        F.round(metrics.macro_f1(F.col(LABEL), F.col("prediction")), 6).alias("macro_f1"),
    )


def _uniform() -> list[Column]:
    return [F.lit(1 / 3)] * 3


@query
def q_metric_improvement(spark, sf_dir):
    """The scorer against one that gives every outcome the same probability."""
    quality = _predicted(spark, sf_dir).agg(
        metrics.log_loss(F.col(LABEL), _uniform()).alias("base_log_loss"),
        metrics.log_loss(F.col(LABEL)).alias("log_loss"),
        metrics.macro_f1(F.col(LABEL), F.lit(0)).alias("base_macro_f1"),
        metrics.macro_f1(F.col(LABEL), F.col("prediction")).alias("macro_f1"),
    )
    gain = metrics.improvement_percent
    return quality.select(
        F.round(gain(F.col("base_log_loss"), F.col("log_loss"), lower_is_better=True), 4).alias(
            "log_loss_gain"
        ),
        F.round(gain(F.col("base_macro_f1"), F.col("macro_f1")), 4).alias("macro_f1_gain"),
    )


@query
def q_partial_dependence(spark, sf_dir):
    curve = audit.partial_dependence(
        inputs.cohort(spark, sf_dir), {"fixed": SCORER}, "arpu", even_grid(0.0, 20000.0, 21)
    )
    return rounded(curve, mean_churn=6)


@query
def q_constraint_steps(spark, sf_dir):
    curve = audit.partial_dependence(
        inputs.cohort(spark, sf_dir), {"fixed": SCORER}, "arpu", even_grid(0.0, 20000.0, 21)
    )
    return rounded(audit.falling_steps(curve), largest_fall=6)


# --- another dataset -------------------------------------------------------------------


@query
def q_external_adapter(spark, sf_dir):
    adapted = external.adapt_external(inputs.churn_export(spark, sf_dir))
    return rounded(adapted.drop("arpu_trend"), catalog_price=4)


@query
def q_external_csv(spark, sf_dir):
    """The same from a landed CSV file."""
    path = scratch_path(spark, "churn-csv")
    export = inputs.churn_export(spark, sf_dir)
    export.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    adapted = external.adapt_external(tables.read_churn_csv(spark, path, export.schema))
    return rounded(adapted.drop("arpu_trend"), catalog_price=4)


@query
def q_external_encode_many(spark, sf_dir):
    """Twenty text columns; those of over 100 values are looked up by shuffle, together."""
    customers = inputs.table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    texts = {
        f"t{i}": F.when(key % (i + 3) != 0, F.concat_ws("-", "c_mktsegment", (key * (i + 1)) % (7 ** (i % 5))))
        for i in range(20)
    }
    named = customers.select("c_custkey", *[t.alias(n) for n, t in texts.items()])
    return external.encode_text(named, broadcast_values=100)


QUERIES.update(MODEL_QUERIES)
QUERIES.update(CHECKS)
QUERIES.update(PRICING)
