"""A mart that grows batch by batch, with the rows that `build_mart` gives for the whole log.

Under one root lie the mart (Parquet by month), the log of all batches, and versions of the
state: a row per customer with what a later purchase needs to know of the earlier ones. A batch
touches

- its own rows: their history goes on where the customer's state left off;
- the last purchase of each customer in it, whose outcome is known now;
- last purchases of others whose grace period has ended since the last batch;
- rows of the batch's months, where a higher price can raise the catalog price;
- all rows of customers with a purchase dated before their last known one, and of those with
  a purchase without a date, which never counts as a renewal, so that the outcome before it
  waits for the grace period like that of a last one: they are rebuilt from the log.

Only months with such rows are rewritten. The state and the list of batches are versions (see
`sources.versions`), completed after the months are written. If an update fails before that,
run it again with the same batch: rows of the batch that are there already give way.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerwise.functions import month_of
from offerwise.operators.catalog import catalog_cells, join_cells
from offerwise.operators.history import NEXT, ORDER, PREV, carried, finished, windows_of
from offerwise.operators.labels import GRACE_DAYS, customer_action
from offerwise.operators.lookup import lookup_left_join
from offerwise.plans.mart import (
    SKEW_LIMITS,
    STATIC_IP_PATTERN,
    mart_rows,
    stage_purchases,
    with_hidden_discount,
)
from offerwise.schemas import LABEL, MONEY, purchases_schema
from offerwise.session import store
from offerwise.sources.tables import read_mart
from offerwise.sources.versions import complete, current_version, manifest, next_version, version_path

MONTH = "purchase_month"
ROW = ["username", "purchaseid"]


def append_batch(
    batch: DataFrame,
    root: str,
    as_of: dt.date | str,
    grace_days: int = GRACE_DAYS,
    static_ip_pattern: str = STATIC_IP_PATTERN,
    **skew_limits: int,
) -> int:
    """Add a batch of purchases to the mart under `root`, the first one included; its number.

    `as_of` is the day up to which outcomes are known; it cannot go back. Grace days and
    pattern must stay as they were. Purchases are told apart by customer and purchase id; one
    that is in the log already must not come again.
    """
    spark = batch.sparkSession
    limits = SKEW_LIMITS | skew_limits
    known = current_version(spark, root)
    facts = manifest(spark, root, known) if known else {"batches": [], "as_of": None}
    as_of = str(as_of)
    if facts["as_of"] and as_of < facts["as_of"]:
        raise ValueError(f"the mart is known as of {facts['as_of']}, which is after {as_of}")
    number = next_version(spark, root)
    log = batch.select(*purchases_schema().names)
    log.withColumn(MONTH, month_of(F.col("purchasedate"))).hint("rebalance", MONTH).write.mode(
        "overwrite"
    ).partitionBy(MONTH).parquet(f"{root}/log/batch={number}")
    whole = _log(spark, root, [*facts["batches"], number], log.schema)
    new = whole.where(F.col("batch") == number).drop("batch")
    state = _state(spark, root, known, new)

    firsts = new.groupBy("username").agg(F.min(F.struct(*ORDER, F.struct(*NEXT).alias("row"))).alias("first"))
    met = lookup_left_join(firsts, state, ["username"])
    order = [F.struct(*[F.col(f"{side}.{c}") for c in ORDER]) for side in ("first", "last")]
    late = F.coalesce(F.col("last").isNotNull() & ((order[0] <= order[1]) | F.col("undated")), F.lit(False))
    met = store(met.withColumn("late", late), "customers-of-batch")
    late = met.where("late").select("username").union(state.where("undated").select("username")).distinct()
    some_late = not late.isEmpty()
    rebuilt = _matching(whole.drop("batch"), late, ["username"], "left_semi") if some_late else new.limit(0)

    updates = store(_outcomes(met, state, facts["as_of"], as_of, grace_days), "known-outcomes")
    touched = _months(new)
    affected = sorted({*touched, *_months(rebuilt), *_months(updates)}, key=str)

    staged = stage_purchases(whole.where(_in(touched)).drop("batch"), static_ip_pattern)
    cells = store(catalog_cells(staged), "cells-of-months")
    rows = new.count()
    cell_limits = (max(rows, cells.count()), limits["broadcast_cells"], limits["hot_cell_rows"])

    def with_history(purchases: DataFrame, count: int) -> DataFrame:
        return windows_of(purchases, count, limits["hot_user_rows"], limits["chunk_rows"])

    def unless_late(df: DataFrame) -> DataFrame:
        return _matching(df, late, ["username"], "left_anti") if some_late else df

    fresh = unless_late(new.drop(MONTH))
    priced = join_cells(stage_purchases(fresh, static_ip_pattern), cells, *cell_limits)
    gone_on = with_history(priced, rows)
    if known:  # before the first batch lies nothing
        gone_on = carried(lookup_left_join(gone_on, _around(met), ["username"]))
    made = mart_rows(finished(gone_on), as_of, grace_days)
    if known:
        mart = read_mart(spark, f"{root}/mart")
        old = unless_late(mart.where(_in(affected)))
        old = _matching(old, new, ROW, "left_anti")
        made = made.unionByName(_updated(old, updates, cells, touched, cell_limits))
    if some_late:
        priced = _priced_again(stage_purchases(rebuilt.drop(MONTH), static_ip_pattern), mart, late, cells, cell_limits)
        whole_history = finished(with_history(priced, rebuilt.count()))
        made = made.unionByName(mart_rows(whole_history, as_of, grace_days))
    if known:  # the months are read while they are written anew
        made = store(made, "rewritten-months")
    _write(made, f"{root}/mart")
    (_merged(state, new) if known else _latest(new)).write.parquet(f"{version_path(root, number)}/state")
    complete(spark, root, number, {"batches": [*facts["batches"], number], "as_of": as_of})
    return number


def incremental_mart(spark: SparkSession, root: str) -> DataFrame:
    """The mart under `root`, as of the last complete batch."""
    return read_mart(spark, f"{root}/mart").drop(MONTH)


def _in(months: list) -> Column:
    """Rows of these months; None stands for rows without a date."""
    dated = F.col(MONTH).isin([m for m in months if m is not None])
    return dated | F.col(MONTH).isNull() if None in months else dated


def _months(df: DataFrame) -> list:
    """The distinct months of some rows: as many as a calendar has."""
    return [r[0] for r in df.select(MONTH).distinct().collect()]


def _matching(df: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join in which NULL keys match each other."""
    renamed = other.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    return df.join(renamed, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], how)


def _log(spark: SparkSession, root: str, batches: list[int], schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema, T.StructField(MONTH, T.DateType()), T.StructField("batch", T.IntegerType())])
    paths = [f"{root}/log/batch={b}" for b in batches]
    return spark.read.schema(full).option("basePath", f"{root}/log").parquet(*paths)


def _latest(purchases: DataFrame) -> DataFrame:
    """A state row per customer: purchases and spend so far, the last one, whether one has no
    date, the latest three disruption counts with their place in the order."""
    last = F.max(F.struct(*ORDER, F.struct("expirationdate", "price", "duration", F.col("flowcount").alias("supportcallcount")).alias("row")))
    totals = purchases.groupBy("username").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price").cast("decimal(28,2)").alias("spent"),
        last.alias("last"),
        F.max(F.col("purchasedate").isNull()).alias("undated"),
    )
    # At most three rows a customer leave a task.
    latest_first = Window.partitionBy("username").orderBy(*[F.desc_nulls_last(c) for c in ORDER])
    tails = (
        purchases.select("username", *ORDER, "disruptioncount")
        .withColumn("back", F.row_number().over(latest_first))
        .where("back <= 3")
        .groupBy("username")
        .agg(F.sort_array(F.collect_list(F.struct(*ORDER, "disruptioncount")), asc=False).alias("recent"))
    )
    return lookup_left_join(totals, tails, ["username"])


def _state(spark: SparkSession, root: str, version: int | None, new: DataFrame) -> DataFrame:
    if version is None:
        return _latest(new.limit(0))
    return spark.read.parquet(f"{version_path(root, version)}/state")


def _merged(state: DataFrame, new: DataFrame) -> DataFrame:
    """The state after a batch. All of it can be added up in any order, late purchases included."""
    both = state.unionByName(_latest(new))
    merged = both.groupBy("username").agg(
        F.sum("n").alias("n"),
        F.sum("spent").cast("decimal(28,2)").alias("spent"),
        F.max("last").alias("last"),
        F.max("undated").alias("undated"),
        F.collect_list("recent").alias("tails"),  # two of three entries
    )
    recent = F.slice(F.sort_array(F.flatten("tails"), asc=False), 1, 3)
    return merged.withColumn("recent", recent).drop("tails")


def _around(met: DataFrame) -> DataFrame:
    """What `carried` needs of each customer's earlier purchases."""
    nothing = F.array().cast("array<bigint>")
    return met.where("not late").select(
        "username",
        F.coalesce("n", F.lit(0)).alias("rows_earlier"),
        F.coalesce("spent", F.lit(0)).alias("spent_earlier"),
        F.col("last.row").alias("row_before"),
        F.lit(None).cast("struct<purchasedate: date, price: decimal(18,2), duration: int>").alias("row_after"),
        F.coalesce(F.col("recent.disruptioncount"), nothing).alias("earlier_disruptions"),
    )


def _outcomes(
    met: DataFrame, state: DataFrame, before: str | None, as_of: str, grace_days: int
) -> DataFrame:
    """Last purchases whose outcome a batch, or the time up to it, decides."""

    def last_rows(rows: DataFrame, following: Column) -> DataFrame:
        judged = rows.select(
            "username",
            F.col("last.purchaseid").alias("purchaseid"),
            month_of(F.col("last.purchasedate")).alias(MONTH),
            *[F.col(f"last.row.{c}").alias(c) for c in ("expirationdate", "price", "duration")],
            *[following[c].alias(f"next_{c}") for c in NEXT],
        )
        return judged.select(*ROW, MONTH, customer_action(as_of, grace_days).alias("known_outcome"))

    renewed = last_rows(met.where("not late and last is not null"), F.col("first.row"))
    nothing = F.lit(None).cast("struct<purchasedate: date, price: decimal(18,2), duration: int>")
    over = F.date_add(F.col("last.row.expirationdate"), grace_days)
    ended = (over >= F.lit(before).cast("date")) & (over < F.lit(as_of).cast("date"))
    waiting = _matching(state.where(ended & ~F.col("undated")), met, ["username"], "left_anti")
    return renewed.unionByName(last_rows(waiting, nothing))


def _updated(
    old: DataFrame, updates: DataFrame, cells: DataFrame, touched: list, cell_limits: tuple
) -> DataFrame:
    """Rows of the mart with outcomes and catalog prices that have changed since."""
    known = lookup_left_join(old, updates.drop(MONTH), ROW)
    known = known.withColumn(LABEL, F.coalesce("known_outcome", LABEL)).drop("known_outcome")
    # What was paid is a price in hundredths, so the difference of doubles gives it exactly.
    paid = F.round(F.col("catalog_price") - F.col("hidden_discount_amount"), 2).cast(MONEY)
    here = known.where(_in(touched)).withColumns({"price": paid, "_before": F.col("catalog_price").cast(MONEY)})
    priced = join_cells(here.drop("catalog_price"), cells, *cell_limits)
    priced = with_hidden_discount(priced.withColumn("catalog_price", F.coalesce("catalog_price", "_before")))
    priced = priced.withColumn("catalog_price", F.col("catalog_price").cast("double"))
    columns = [c for c in old.columns if c != MONTH]
    return priced.select(*columns).unionByName(known.where(~F.coalesce(_in(touched), F.lit(False))).select(*columns))


def _priced_again(
    purchases: DataFrame, mart: DataFrame, customers: DataFrame, cells: DataFrame, cell_limits: tuple
) -> DataFrame:
    """All purchases of some customers. Months without new purchases keep their catalog prices,
    which the mart has."""
    kept = _matching(mart, customers, ["username"], "left_semi").select(
        *ROW, F.col("catalog_price").cast(MONEY).alias("_before")
    )
    priced = join_cells(lookup_left_join(purchases, kept, ROW), cells, *cell_limits)
    return priced.withColumn("catalog_price", F.coalesce("catalog_price", "_before")).drop("_before")


def _write(rows: DataFrame, path: str) -> None:
    dated = rows.withColumn(MONTH, month_of(F.col("purchasedate")))
    (
        dated.hint("rebalance", MONTH)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )
