"""The pricing model on another provider's churn dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerwise.functions import keyed_digest, to_number
from offerwise.models import Learner, fit_outcome_model, scorer_of
from offerwise.operators.lookup import hot_limit, lookup_left_join, skewed_lookup_join
from offerwise.operators.scoring import Scorer
from offerwise.operators.splits import split
from offerwise.plans.strategy import strategy_comparison
from offerwise.schemas import LABEL
from offerwise.session import store

# Markup of the list price, spread of the revenue trend, columns no model reads.
LIST_MARKUP = 1.15
TREND_SPREAD = 5.0
NOT_FEATURES = ("customerID", "Churn", "TotalCharges", LABEL)
EXTERNAL_PRICE_FEATURES = ("catalog_price", "arpu")

BROADCAST_VALUES = 100_000
HOT_VALUE_ROWS = 1_000_000


def external_outcome() -> Column:
    """Churned: 2; staying without a contract term: 1; else 0."""
    stayed_monthly = (F.col("Churn") == "No") & (F.col("Contract") == "Month-to-month")
    return F.when(F.col("Churn") == "Yes", 2).when(stayed_monthly, 1).otherwise(0)


def standard_normal(key: Column, seed: int = 42) -> Column:
    """A standard normal draw that depends on the key alone (Box-Muller on two digests)."""

    def uniform(salt: int) -> Column:
        steps = F.conv(F.substring(keyed_digest(key, f"{seed}|{salt}"), 1, 12), 16, 10)
        return (steps.cast("double") + F.lit(0.5)) / F.lit(float(16**12))

    return F.sqrt(-2 * F.ln(uniform(1))) * F.cos(2 * F.pi() * uniform(2))


def clean_external(df: DataFrame) -> DataFrame:
    """Total charges as a number; rows with any gap are dropped."""
    return df.withColumn("TotalCharges", to_number(F.col("TotalCharges"))).na.drop("any")


def with_external_economics(df: DataFrame, seed: int = 42) -> DataFrame:
    """Outcome, list price and revenue of each customer."""
    return df.withColumns(
        {
            LABEL: external_outcome(),
            "catalog_price": F.col("MonthlyCharges") * LIST_MARKUP,
            "arpu": F.col("MonthlyCharges"),
            "arpu_trend": standard_normal(F.col("customerID"), seed) * TREND_SPREAD,
        }
    )


def text_features(df: DataFrame) -> list[str]:
    skipped = {c.lower() for c in NOT_FEATURES}
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and f.name.lower() not in skipped
    ]


def encode_text(
    df: DataFrame, columns: list[str] | None = None, broadcast_values: int = BROADCAST_VALUES
) -> DataFrame:
    """Replace text columns by the rank of each value among the column's sorted values, from 0.

    All columns share one dictionary, so that any number of them takes one exchange of counts
    and one of distinct values (see `ranked_values`). Columns of few values are looked up by
    broadcast, beside each other; those of many by shuffle, together: their values are listed
    one to a row, joined once, and put back by row.
    """
    columns = text_features(df) if columns is None else columns
    if not columns:
        return df
    codes = store(ranked_values(df, columns), "text-codes")
    sizes = codes.groupBy("column").agg(F.sum("rows").alias("rows"), F.count("*").alias("values"))
    found = {r["column"]: (r["rows"], r["values"]) for r in sizes.collect()}  # a row per column
    many = [c for c in columns if found.get(c, (0, 0))[1] > broadcast_values]
    encoded = df
    for column in (c for c in columns if c not in many):
        own = codes.where(F.col("column") == column).select(F.col("value").alias(column), "rank")
        joined = lookup_left_join(encoded, F.broadcast(own), [column])
        encoded = joined.withColumn(column, F.col("rank")).select(*df.columns)
    return _looked_up(encoded, many, codes, sum(found[c][0] for c in many)) if many else encoded


def _entries(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """(column, value) of all `columns`, a row for each."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*pairs)))


def ranked_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, rank from 0, rows) of the distinct values of columns, NULL left out.

    Values are counted map-side and range-partitioned by column and value; each partition is
    ranked on its own, after the values of those before it. The partition numbers are stored,
    so that they cannot change between the two reads.
    """
    entries = _entries(df, columns).where(F.col("value").isNotNull())
    placed = store(
        entries.groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .repartitionByRange("column", "value")
        .withColumn("part", F.spark_partition_id()),
        "text-values",
    )
    # A row per column and partition.
    sizes = placed.groupBy("column", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("column", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("column", "part").orderBy("value")
    ranked = placed.join(F.broadcast(before), ["column", "part"])
    rank = (F.col("before") + F.row_number().over(inside) - 1).cast("int")
    return ranked.select("column", "value", rank.alias("rank"), "rows")


def _looked_up(df: DataFrame, columns: list[str], codes: DataFrame, rows: int) -> DataFrame:
    """`df` with `columns` replaced by their ranks, by one shuffle join for all of them."""
    wanted = codes.where(F.col("column").isin(columns))
    # At most MOST_HOT_KEYS values are hot, whatever the size of the input.
    hot = wanted.where(F.col("rows") > hot_limit(HOT_VALUE_ROWS, rows)).drop("rows")
    key = ["column", "value"]
    if len(columns) == 1:
        column = columns[0]
        own = [t.drop("column").withColumnRenamed("value", column) for t in (wanted.drop("rows"), hot)]
        spread = F.struct(*[c for c in df.columns if c != column])
        joined = skewed_lookup_join(df, *own, [column], spread_by=spread)
        return joined.withColumn(column, F.col("rank")).select(*df.columns)
    # The row numbers are stored, since both sides of the last join must agree on them.
    numbered = store(df.withColumn("_row", F.monotonically_increasing_id()), "numbered-rows")
    long = _entries(numbered, columns, "_row")
    joined = skewed_lookup_join(long, wanted.drop("rows"), hot, key, spread_by=F.col("_row"))
    names = {c: f"_rank_{i}" for i, c in enumerate(columns)}
    wide = joined.groupBy("_row").agg(
        *[F.max(F.when(F.col("column") == c, F.col("rank"))).alias(n) for c, n in names.items()]
    )
    back = numbered.join(wide, "_row")
    return back.select(*[F.col(names[c]).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns])


def adapt_external(df: DataFrame, seed: int = 42) -> DataFrame:
    """External churn rows in the shape our models train on."""
    return encode_text(with_external_economics(clean_external(df), seed))


def external_features(adapted: DataFrame) -> list[str]:
    skipped = {c.lower() for c in NOT_FEATURES}
    return [c for c in adapted.columns if c.lower() not in skipped]


def external_policy(adapted: DataFrame, scorer: Scorer, probs: str = "static") -> DataFrame:
    """Discounts handed out by the threshold policy and by value maximisation.

    The three-state model's churn probability drives the threshold policy. One
    billing period stands in for the subscription length.
    """
    portfolio = adapted.withColumn("duration", F.lit(1))
    return strategy_comparison(portfolio, scorer, probs=probs).select(
        "users", "threshold_discounts", "value_discounts"
    )


def external_run(df: DataFrame, seed: int = 42, key: str = "customerID") -> DataFrame:
    """Adapt, fit the price-constrained model on 70 % and count both policies on the rest."""
    adapted = adapt_external(df, seed)
    fitting, unseen = split(adapted, key)
    learner = Learner(rising_with_price=EXTERNAL_PRICE_FEATURES)
    model = fit_outcome_model(fitting, external_features(adapted), learner)
    return external_policy(unseen, scorer_of(model))
