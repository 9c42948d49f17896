"""Versioned models, the growing mart, bucketed tables, checked files and shared dictionaries."""

import pytest
from pyspark.sql import functions as F

from offerwise import models
from offerwise.operators.history import with_history
from offerwise.plans import external
from offerwise.plans.incremental import append_batch, incremental_mart
from offerwise.plans.mart import build_mart, stage_purchases
from offerwise.registry import inputs
from offerwise.schemas import cohort_schema
from offerwise.sources import quarantine, tables, versions
from offerwise.sources.purchases import read_purchases

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def log(spark):
    return inputs.purchases(spark, SF_DIR).persist()


# --- versions ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def fitted(spark):
    rows = inputs.cohort(spark, SF_DIR)
    return [
        models.fit_outcome_model(rows, ["arpu", *more], models.Learner(params={"maxIter": 5}))
        for more in ([], ["duration"])
    ]


def test_published_versions(spark, tmp_path, fitted):
    path = str(tmp_path / "models")
    assert models.publish(spark, fitted[0], path, {"f1": 0.5}) == 1
    assert models.publish(spark, fitted[1], path, {"f1": 0.25}) == 2
    assert models.model_features(models.load_model(path)) == ["arpu", "duration"]
    assert models.model_features(models.load_model(path, 1)) == ["arpu"]
    rows = models.model_versions(spark, path).orderBy("version").collect()
    assert [tuple(r) for r in rows] == [
        (1, False, ["arpu"], {"f1": 0.5}),
        (2, True, ["arpu", "duration"], {"f1": 0.25}),
    ]
    models.roll_back(spark, path, 1)
    assert models.model_features(models.load_model(path)) == ["arpu"]
    with pytest.raises(ValueError, match="no complete version 7"):
        models.roll_back(spark, path, 7)


def test_a_failed_write_leaves_the_model(spark, tmp_path, fitted, monkeypatch):
    path = str(tmp_path / "models")
    models.publish(spark, fitted[0], path)

    class Broken:
        """Writes some files, then fails."""

        def write(self):
            return self

        def save(self, at):
            fitted[1].write().save(at)
            raise OSError("executor lost")

    with pytest.raises(OSError):
        models.publish(spark, Broken(), path)
    assert models.model_features(models.load_model(path)) == ["arpu"]
    # Nor does a manifest without a pointer count.
    with monkeypatch.context() as patched:
        patched.setattr(versions, "make_current", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            models.publish(spark, fitted[1], path)
    assert models.model_features(models.load_model(path)) == ["arpu"]
    assert models.publish(spark, fitted[1], path) == 4
    assert models.model_features(models.load_model(path)) == ["arpu", "duration"]


def test_versions_are_never_written_twice(spark, tmp_path):
    root = str(tmp_path / "root")
    assert versions.current_version(spark, root) is None and versions.next_version(spark, root) == 1
    versions.complete(spark, root, 1, {"a": 1})
    with pytest.raises(FileExistsError):
        versions.complete(spark, root, 1, {"a": 2})
    assert versions.manifests(spark, root) == [{"version": 1, "a": 1}]


# --- the growing mart --------------------------------------------------------------------


def differing(a, b):
    assert a.columns == b.columns and a.dtypes == b.dtypes
    return a.exceptAll(b).count() + b.exceptAll(a).count()


def built(log, as_of, **limits):
    return build_mart(log, as_of, static_ip_pattern=inputs.STATIC_IP, **limits)


def test_mart_grows_to_the_same_rows(spark, log, tmp_path):
    """Batch by batch: purchases in order, late ones, batches without any, new customers."""
    root = str(tmp_path / "mart")
    late = F.when(F.col("purchaseid") % 7 == 0, 1).otherwise(0)
    number = (F.year("purchasedate") - 1999).cast("int")
    placed = log.withColumn("batch", F.least(F.greatest(number, F.lit(0)) + late, F.lit(2))).persist()
    seen = placed.limit(0)
    for batch, as_of in enumerate(["1999-12-31", "2000-06-30", "2000-12-31"]):
        rows = placed.where(F.col("batch") == batch)
        seen = seen.unionByName(rows)
        append_batch(rows, root, as_of, static_ip_pattern=inputs.STATIC_IP)
        assert differing(incremental_mart(spark, root), built(seen.drop("batch"), as_of)) == 0
    # Time alone closes outcomes.
    append_batch(log.limit(0), root, inputs.AS_OF, static_ip_pattern=inputs.STATIC_IP)
    assert differing(incremental_mart(spark, root), built(placed.drop("batch"), inputs.AS_OF)) == 0
    with pytest.raises(ValueError, match="after"):
        append_batch(log.limit(0), root, "1999-01-01", static_ip_pattern=inputs.STATIC_IP)


def test_mart_of_hot_customers_and_gaps(spark, log, tmp_path):
    """Half of all purchases of one customer; rows without date, name or disruption count."""
    root = str(tmp_path / "mart")
    key = F.col("purchaseid")
    odd = log.withColumns(
        {
            "username": F.when(key % 2 == 0, F.lit(1)).when(key % 23 != 1, F.col("username")).cast("bigint"),
            "purchasedate": F.when(key % 29 != 3, F.col("purchasedate")),
            "disruptioncount": F.when(key % 5 != 2, F.col("disruptioncount")),
        }
    ).persist()
    limits = {"hot_user_rows": 20, "chunk_rows": 50}
    cut = F.coalesce(F.col("purchasedate") < "2000-06-01", key % 2 == 0)
    for rows, as_of in ((odd.where(cut), "2000-06-01"), (odd.where(~cut), inputs.AS_OF)):
        append_batch(rows, root, as_of, static_ip_pattern=inputs.STATIC_IP, **limits)
    assert differing(incremental_mart(spark, root), built(odd, inputs.AS_OF)) == 0


def test_failed_batch_can_be_run_again(spark, log, tmp_path, monkeypatch):
    root = str(tmp_path / "mart")
    cut = F.col("purchasedate") < "2000-06-01"
    append_batch(log.where(cut), root, "2000-06-01", static_ip_pattern=inputs.STATIC_IP)
    from offerwise.plans import incremental

    with monkeypatch.context() as patched:
        patched.setattr(incremental, "complete", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            append_batch(log.where(~cut), root, inputs.AS_OF, static_ip_pattern=inputs.STATIC_IP)
    append_batch(log.where(~cut), root, inputs.AS_OF, static_ip_pattern=inputs.STATIC_IP)
    assert differing(incremental_mart(spark, root), built(log, inputs.AS_OF)) == 0


def test_only_touched_months_are_rewritten(spark, log, tmp_path):
    root = tmp_path / "mart"
    cut = F.col("purchasedate") < "2001-07-01"
    append_batch(log.where(cut), str(root), "2001-07-01", static_ip_pattern=inputs.STATIC_IP)
    before = {p: p.stat().st_mtime_ns for p in root.glob("mart/*/*.parquet")}
    append_batch(log.where(~cut), str(root), inputs.AS_OF, static_ip_pattern=inputs.STATIC_IP)
    kept = [p for p, t in before.items() if p.exists() and p.stat().st_mtime_ns == t]
    assert len(kept) > len(before) / 2


# --- bucketed tables ---------------------------------------------------------------------


def test_bucketed_history_needs_no_exchange(spark, log, tmp_path):
    table = tables.save_by_customer(log, "bucketed_log", 4, str(tmp_path / "table"))
    plan = with_history(stage_purchases(table))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan
    by_customer = read_purchases(spark, "bucketed_log", "table").groupBy("username").count()
    assert "Exchange" not in by_customer._jdf.queryExecution().executedPlan().toString()
    assert table.exceptAll(log.select(*table.columns)).count() == 0
    assert len(list((tmp_path / "table").glob("*.parquet"))) == 4
    spark.sql("drop table bucketed_log")


# --- checked files -----------------------------------------------------------------------


def test_bad_rows_are_kept_apart(spark, tmp_path):
    path = tmp_path / "cohort.csv"
    names = ",".join(cohort_schema().names)
    path.write_text(
        f"{names}\na,1,1,0,30,1\nb,cheap,1,0,30,1\nc,1,1,0,30\nd,1,1,0,30,1,9\n,1,1,0,30,1\n"
        "e,,1,0,30,1\nf,-5,1,0,30,1\ng,2,1,0,30,\n"
    )
    checked = quarantine.read_checked_cohort(spark, str(path))
    checked.write(str(tmp_path / "good"), str(tmp_path / "bad"))
    good = spark.read.parquet(str(tmp_path / "good")).orderBy("username").collect()
    assert [(r.username, r.catalog_price) for r in good] == [("a", 1.0), ("g", 2.0)]
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted(r.reason for r in bad) == [
        "malformed", "malformed", "malformed", "negative price", "no catalog_price", "no username",
    ]
    assert {r.file for r in bad} == {"cohort.csv"}
    assert ("b,cheap,1,0,30,1", "malformed") in {(r.line, r.reason) for r in bad}
    path.write_text("username,arpu\na,1\n")
    with pytest.raises(ValueError, match="catalog_price"):
        quarantine.read_checked_cohort(spark, str(path))


# --- dictionaries ------------------------------------------------------------------------


def test_many_columns_share_one_dictionary(spark):
    rows = spark.range(500).selectExpr(
        "id",
        *[f"if(id % {i + 2} = 0, null, concat('v', (id * 7) % {3 + 40 * (i % 3)})) as c{i}" for i in range(20)],
    )
    columns = [f"c{i}" for i in range(20)]
    data = {r.id: r for r in rows.collect()}
    ranks = [{v: k for k, v in enumerate(sorted({r[c] for r in data.values()} - {None}))} for c in columns]
    for limit in (1000, 10, 0):
        encoded = external.encode_text(rows, columns, broadcast_values=limit)
        assert encoded.columns == rows.columns and encoded.count() == 500
        for row in encoded.collect():
            assert [row[c] for c in columns] == [
                None if (v := data[row.id][c]) is None else ranks[i][v] for i, c in enumerate(columns)
            ]
    assert external.encode_text(rows.limit(0), columns).count() == 0
    assert external.encode_text(rows, []) is rows


def test_counts_of_all_columns_take_one_exchange(spark):
    rows = spark.range(50).selectExpr("cast(id % 7 as string) a", "cast(id % 5 as string) b", "cast(id as string) c")
    entries = external._entries(rows, ["a", "b", "c"]).groupBy("column", "value").count()
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
