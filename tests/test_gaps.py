"""NULL and NaN in metrics, text of any cardinality, hot keys without a match, stored tables."""

import math

import pytest
from pyspark.sql import functions as F

from offerwise.operators.lookup import MOST_HOT_KEYS, hot_limit
from offerwise.operators.metrics import class_weights, log_loss, with_class_weights
from offerwise.operators.scoring import hard_prediction
from offerwise.operators.value import with_expected_value
from offerwise.plans.external import encode_text
from offerwise.plans.strategy import alpha_sensitivity
from offerwise.registry.inputs import SCORER
from offerwise.session import clear_stored, store
from offerwise.sources.purchases import _with_part_names
from offerwise.sources.tables import read_cohort_csv, with_row_id

SCORES = "customer_action int, p_accept double, p_downgrade double, p_churn double"


def loss(spark, rows):
    return spark.createDataFrame(rows, SCORES).agg(log_loss(F.col("customer_action"))).first()[0]


def test_log_loss_of_gaps(spark):
    good = [(0, 0.5, 0.3, 0.2), (2, 0.1, 0.2, 0.7)]
    expected = -(math.log(0.5) + math.log(0.7)) / 2
    assert loss(spark, good) == pytest.approx(expected)
    assert loss(spark, [*good, (None, float("nan"), None, 0.1)]) == pytest.approx(expected)
    assert loss(spark, [*good, (1, 0.1, float("nan"), 0.1)]) is None
    assert loss(spark, [*good, (1, 0.1, None, 0.1)]) is None


def test_prediction_of_gaps(spark):
    rows = [(0, 0.5, 0.3, 0.2), (0, None, 0.3, 0.2), (0, 0.1, float("nan"), 0.2), (0, 0.2, 0.4, 0.4)]
    got = spark.createDataFrame(rows, SCORES).select(hard_prediction().alias("p"))
    assert [r.p for r in got.collect()] == [0, None, None, 1]


def test_class_weights_keep_rows_without_label(spark):
    df = spark.createDataFrame([(0,), (1,), (1,), (2,), (None,)], "customer_action int")
    assert {r.customer_action: r.class_weight for r in class_weights(df).collect()} == {
        0: pytest.approx(4 / 3), 1: pytest.approx(2 / 3), 2: pytest.approx(4 / 3)
    }
    assert with_class_weights(df).count() == 5


def test_text_of_any_cardinality_is_encoded(spark):
    df = spark.range(150_000).select(
        "id", F.format_string("v%06d", F.col("id") * 7 % 150_000).alias("name"), F.lit("x").alias("one")
    )
    wrong = encode_text(df).where((F.col("name") != F.col("id") * 7 % 150_000) | (F.col("one") != 0))
    assert wrong.count() == 0


def test_hot_keys_are_bounded():
    assert hot_limit(1_000_000, 10**9) == 1_000_000
    assert 10**13 / hot_limit(1_000_000, 10**13) <= MOST_HOT_KEYS


def test_lines_without_a_part_do_not_gather(spark):
    key = F.when(F.col("id") % 2 == 0, F.lit(None)).when(F.col("id") % 4 == 1, -1).otherwise(F.col("id"))
    lines = spark.range(8000).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), key.cast("bigint").alias("l_partkey")
    )
    part = spark.range(8000).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = _with_part_names(lines, part, 100)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert joined.count() == 8000 and joined.where("p_name is not null").count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 4 and max(sizes) < 2400


def test_flat_discount_off_the_grid_is_priced(spark):
    row = [(1, 100.0, 10.0, 1.0, 10)]
    cohort = spark.createDataFrame(row, "id int, catalog_price double, arpu double, arpu_trend double, duration int")
    flat = alpha_sensitivity(cohort, SCORER, alphas=(0.7,), flat=0.12).first().flat_value
    scored = SCORER(cohort).withColumn("offered_price", F.lit(88.0))
    assert flat == pytest.approx(with_expected_value(scored).first().expected_value)


def test_cohort_file_needs_five_columns(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text("duration,arpu,gap_days,username,catalog_price,arpu_trend,note\n30,1.5,4,u,45,0.5,x\n")
    row = read_cohort_csv(spark, str(good)).first()
    assert (row.duration, row.gap_days, row.username, row.note) == (30, 4, "u", "x")
    assert with_row_id(read_cohort_csv(spark, str(good))).columns[-1] == "purchaseid"
    bad = tmp_path / "bad.csv"
    bad.write_text("duration,arpu,username,catalog_price\n30,1.5,u,45\n")
    with pytest.raises(ValueError, match="arpu_trend"):
        read_cohort_csv(spark, str(bad))


def test_stored_tables_can_be_cleared(spark):
    kept = store(spark.range(3), "to-clear")
    assert kept.count() == 3
    path = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    from offerwise import session

    own = session._paths[spark.sparkContext.applicationId]
    mine = [p for p in own if p.endswith(path.rsplit("/", 1)[1])]
    rest = [p for p in own if p not in mine]
    session._paths[spark.sparkContext.applicationId] = mine
    import os

    assert clear_stored(spark) == 1 and not os.path.exists(path)
    session._paths[spark.sparkContext.applicationId] = rest
