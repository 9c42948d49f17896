"""Hot keys take another way through the plan and give the same rows."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from offerwise.operators import splits
from offerwise.operators.catalog import with_catalog_price
from offerwise.operators.history import with_history
from offerwise.plans.mart import build_mart, stage_purchases
from offerwise.schemas import purchases_schema
from offerwise.sources.purchases import purchases_from_orders


@pytest.fixture(scope="module")
def log(spark):
    """A third of all purchases belong to one customer, many on one date; some have no name."""
    draw = random.Random(5)
    rows = []
    for k in range(300):
        user = "hot" if k % 3 == 0 else None if k % 11 == 0 else f"u{draw.randrange(25)}"
        day = 5 if draw.random() < 0.3 else draw.randrange(200)
        start = dt.date(2024, 1, 1) + dt.timedelta(days=day)
        rows.append(
            {
                "username": user, "purchaseid": f"{k:04}", "purchasedate": start,
                "expirationdate": start + dt.timedelta(days=30),
                "price": None if k % 29 == 0 else Decimal(draw.randrange(100, 10_000)) / 100,
                "duration": draw.choice([0, 30, 90]), "bandwidth": draw.choice([None, 50, 100]),
                "gig_product": 0, "productname": draw.choice(["Static IP", "Home", None]),
                "flowcount": draw.randrange(5),
                "disruptioncount": None if k % 7 == 0 else draw.randrange(9),
            }
        )
    return spark.createDataFrame(rows, purchases_schema()).repartition(5)


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("chunk_rows", [1, 2, 7, 1000])
def test_split_history_equals_one_window(log, chunk_rows):
    staged = stage_purchases(log).repartition(4)
    plain = with_history(staged)
    split = with_history(staged, hot_user_rows=15, chunk_rows=chunk_rows)
    assert rows_of(split) == rows_of(plain)


def test_history_without_hot_users(log):
    staged = stage_purchases(log)
    assert rows_of(with_history(staged, hot_user_rows=200)) == rows_of(with_history(staged))


@pytest.mark.parametrize("hot_cell_rows", [0, 20, 10_000])
def test_many_cells_equal_broadcast_cells(log, hot_cell_rows):
    staged = stage_purchases(log)
    many = with_catalog_price(staged, broadcast_cells=3, hot_cell_rows=hot_cell_rows)
    assert rows_of(many) == rows_of(with_catalog_price(staged))


def test_stored_but_few_cells_are_broadcast(log):
    staged = stage_purchases(log)
    few = with_catalog_price(staged, broadcast_cells=staged.count() - 1)
    assert rows_of(few) == rows_of(with_catalog_price(staged))


@pytest.mark.parametrize("hot_part_lines", [3, 50, 10_000])
def test_hot_parts_do_not_change_the_log(spark, hot_part_lines):
    orders = spark.range(40).selectExpr(
        "id o_orderkey", "id % 7 o_custkey", "id * 1.5 o_totalprice",
        "timestamp_ntz'2024-01-01 00:00:00' o_orderdate", "'2-HIGH' o_orderpriority",
    )
    lines = spark.range(120).selectExpr(
        "id % 39 l_orderkey", "if(id % 3 = 0, null, if(id % 2 = 0, 1, id)) l_partkey",
        "cast(id as int) l_linenumber", "cast(id % 45 as double) l_quantity",
        "if(id % 5 = 0, 'R', 'N') l_returnflag", "if(id % 4 = 0, 'O', 'F') l_linestatus",
    )
    part = spark.range(100).selectExpr("id p_partkey", "concat('part ', id) p_name")
    plain = purchases_from_orders(orders, lines, part)
    split = purchases_from_orders(orders, lines, part, hot_part_lines=hot_part_lines)
    assert rows_of(split) == rows_of(plain)
    assert split.count() == 40


def test_mart_does_not_depend_on_layout(log):
    built = build_mart(log, "2024-08-01")
    again = build_mart(log.repartition(1), "2024-08-01", hot_user_rows=30, chunk_rows=20,
                       broadcast_cells=5, hot_cell_rows=10)
    assert rows_of(built) == rows_of(again)
    assert built.count() == 300


@pytest.mark.parametrize("direct", [10, 10**6])
def test_sample_takes_the_smallest_hashes(spark, monkeypatch, direct):
    monkeypatch.setattr(splits, "DIRECT_SAMPLE_ROWS", direct)
    df = spark.range(20_000).withColumnRenamed("id", "purchaseid")
    expected = [
        r.purchaseid
        for r in df.selectExpr("purchaseid", "md5(concat(purchaseid, '|42')) h").orderBy("h").take(50)
    ]
    assert [r.purchaseid for r in splits.sample_rows(df, 50).collect()] == expected


def test_sample_larger_than_input(spark):
    df = spark.range(7).withColumnRenamed("id", "purchaseid")
    assert splits.sample_rows(df, 1000).count() == 7


def test_sample_with_one_repeated_key_is_full(spark, monkeypatch):
    monkeypatch.setattr(splits, "DIRECT_SAMPLE_ROWS", 10)
    df = spark.range(5000).selectExpr("1 as purchaseid", "id")
    assert splits.sample_rows(df, 50).count() == 50


def test_stratified_split_is_exact(spark):
    df = spark.range(1003).selectExpr("id purchaseid", "cast(id % 10 > 6 as int) label")
    placed = splits.stratified_split(df, "label")
    counts = {
        (r.label, r.in_train): r.n
        for r in placed.groupBy("label", "in_train").count().withColumnRenamed("count", "n").collect()
    }
    zeros = df.where("label = 0").count()
    assert counts[0, True] == round(zeros * 0.8)
    assert counts[1, True] == round((1003 - zeros) * 0.8)
    assert placed.count() == 1003


def test_split_is_stable_and_complete(spark):
    df = spark.range(1000).withColumnRenamed("id", "purchaseid")
    train, test = splits.split(df)
    again, _ = splits.split(df.repartition(3))
    assert rows_of(train) == rows_of(again)
    assert train.count() + test.count() == 1000
    assert train.intersect(test).count() == 0
    assert 600 < train.count() < 800
