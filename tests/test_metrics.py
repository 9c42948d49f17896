import math

import pytest
from pyspark.sql import functions as F

from offerwise import functions as fn
from offerwise.operators import metrics
from offerwise.operators.scoring import hard_prediction
from offerwise.plans import audit


@pytest.fixture(scope="module")
def predicted(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)] + [(2, 0)] * 4
    return spark.createDataFrame(pairs, "customer_action int, prediction int")


def test_report_against_hand_computed_confusion(predicted):
    rows = {r["class"]: r for r in metrics.class_report(predicted).collect()}
    accept, down, churn = rows["accept"], rows["downgrade"], rows["churn"]
    assert (accept.precision, accept.recall) == (5 / 10, 5 / 7)
    assert accept.f1 == pytest.approx(10 / 17)
    assert (down.precision, down.recall, down.support) == (3 / 5, 3 / 4, 4)
    assert (churn.precision, churn.recall, churn.f1) == (0, 0, 0)  # 0/0 counts as 0
    assert rows["accuracy"].f1 == pytest.approx(8 / 15)
    assert rows["macro avg"].f1 == pytest.approx((10 / 17 + 6 / 9) / 3)
    assert rows["weighted avg"].recall == pytest.approx(8 / 15)


def test_log_loss_clips(spark):
    df = spark.createDataFrame(
        [(0, 0.5, 0.25, 0.25), (2, 1.0, 0.0, 0.0)],
        "customer_action int, p_accept double, p_downgrade double, p_churn double",
    )
    loss = df.agg(metrics.log_loss(F.col("customer_action"))).first()[0]
    assert loss == pytest.approx((math.log(2) - math.log(1e-15)) / 2)


def test_first_of_equal_classes_wins(spark):
    df = spark.createDataFrame(
        [(0.4, 0.4, 0.2), (0.2, 0.4, 0.4), (0.1, 0.2, 0.7)],
        "p_accept double, p_downgrade double, p_churn double",
    )
    assert [r[0] for r in df.select(hard_prediction()).collect()] == [0, 1, 2]


def test_improvement_over_zero_is_unknown(spark):
    gain = metrics.improvement_percent(F.lit(0.0), F.lit(1.0))
    assert spark.range(1).select(gain).first()[0] is None


def test_shares_leave_out_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    assert [tuple(r) for r in metrics.value_shares(df, "v").collect()] == [
        (1, 2, pytest.approx(200 / 3)),
        (2, 1, pytest.approx(100 / 3)),
    ]


def test_class_weights_balance(predicted):
    weighted = metrics.with_class_weights(predicted)
    sums = weighted.groupBy("customer_action").agg(F.sum("class_weight").alias("s")).collect()
    assert all(r.s == pytest.approx(5) for r in sums)


def test_falling_steps(spark):
    curve = spark.createDataFrame(
        [("m", 0, 0.1), ("m", 1, 0.3), ("m", 2, 0.25), ("m", 3, 0.4)],
        "model string, point int, mean_churn double",
    )
    row = audit.falling_steps(curve).first()
    assert (row.points, row.falling_steps) == (4, 1)
    assert row.largest_fall == pytest.approx(0.05)


def test_small_functions(spark):
    one = spark.range(1)

    def value(column):
        return one.select(column).first()[0]

    assert value(fn.safe_ratio(F.lit(7), F.lit(2))) == 3.5
    assert value(fn.safe_ratio(F.lit(7), F.lit(0))) == 0.0
    assert value(fn.safe_ratio(F.lit(7), F.lit(None).cast("int"))) == 0.0
    assert value(fn.to_number(F.lit(" "))) is None
    assert value(fn.percent_label(F.lit(0.24999999999999997))) == "25%"
    assert value(fn.is_close(F.lit(0.15000000000000002), 0.15)) is True
    assert value(fn.is_close(F.lit(0.1501), 0.15)) is False
    assert fn.discount_grid() == [0.0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3]
    assert fn.even_grid(0.4, 0.9, 6) == [0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
    big = fn.softmax(["1000D", "0D", "-1000D"])
    assert [value(F.expr(p)) for p in big] == [1.0, 0.0, 0.0]
