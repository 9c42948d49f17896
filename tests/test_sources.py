import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerwise.registry import inputs
from offerwise.schemas import cohort_schema, purchases_schema
from offerwise.sources import purchases, tables

SF_DIR = "/root/testdata/sf0.001"


def test_purchase_log_from_parquet(spark, tmp_path):
    path = str(tmp_path / "log")
    inputs.purchases(spark, SF_DIR).withColumn("extra", F.lit(1)).write.parquet(path)
    log = purchases.read_purchases(spark, path)
    assert log.columns == purchases_schema().names
    assert log.schema["username"].dataType == T.LongType()
    assert log.count() == 1500


def test_purchase_log_without_columns(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError, match="purchasedate"):
        purchases.read_purchases(spark, path)


def test_mart_is_pruned_by_month(spark, tmp_path):
    path = str(tmp_path / "mart")
    tables.write_mart(inputs.mart(spark, SF_DIR), path)
    month = tables.read_mart(spark, path).where("purchase_month = date'1997-03-01'")
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_month" in plan
    assert month.where("month(purchasedate) <> 3").count() == 0
    assert month.count() > 0


def test_cohort_csv(spark, tmp_path):
    path = tmp_path / "cohort.csv"
    path.write_text(
        "username,catalog_price,arpu,arpu_trend,duration,rolling_3_disruptioncount\n"
        "user_a,120000,4000,0,30,1\nuser_b,85000,2666.5,-50,30,\n"
    )
    rows = tables.read_cohort_csv(spark, str(path)).collect()
    assert rows[1].arpu == 2666.5
    assert rows[1].rolling_3_disruptioncount is None


def test_bad_cohort_csv_fails(spark, tmp_path):
    path = tmp_path / "cohort.csv"
    path.write_text(",".join(cohort_schema().names) + "\nu,cheap,1,1,30,0\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_cohort_csv(spark, str(path)).collect()


def test_missing_file(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)path"):
        tables.read_features_csv(spark, str(tmp_path / "absent")).count()


def test_churn_csv(spark, tmp_path):
    path = tmp_path / "churn.csv"
    header = "customerID,TotalCharges,MonthlyCharges,Contract,Churn,PaymentMethod"
    path.write_text(f"{header}\n7,29.85,29.85,Month-to-month,No,Check\n8, ,10,Two year,Yes,Card\n")
    schema = "customerID string, TotalCharges string, MonthlyCharges double, " \
             "Contract string, Churn string, PaymentMethod string"
    df = tables.read_churn_csv(spark, str(path), T.StructType.fromDDL(schema))
    from offerwise.plans.external import adapt_external

    rows = adapt_external(df).collect()
    assert len(rows) == 1  # a blank total drops the row
    assert (rows[0].customer_action, rows[0].Contract, rows[0].PaymentMethod) == (1, 0, 0)
    assert rows[0].catalog_price == pytest.approx(29.85 * 1.15)
