import datetime as dt
from decimal import Decimal

import pytest

from offerwise.plans.mart import build_mart
from offerwise.schemas import mart_schema, purchases_schema

AS_OF = dt.date(2024, 6, 1)
DAY = dt.timedelta(days=1)


def purchase(user, number, start, price=30, days=30, **more):
    row = {
        "username": user, "purchaseid": f"{user}-{number}", "purchasedate": start,
        "expirationdate": start + days * DAY if days else start, "duration": days,
        "price": None if price is None else Decimal(price), "bandwidth": 50,
        "gig_product": 0, "productname": "Home", "flowcount": 1, "disruptioncount": 0,
    }
    return row | more


@pytest.fixture
def mart(spark):
    def build(*rows, **options):
        log = spark.createDataFrame(list(rows), purchases_schema())
        return {r.purchaseid: r for r in build_mart(log, AS_OF, **options).collect()}

    return build


START = dt.date(2024, 1, 1)
EXPIRY = START + 30 * DAY


@pytest.mark.parametrize(
    ("renewal", "price", "days", "action"),
    [
        (EXPIRY + 15 * DAY, 30, 30, 0),  # last day of grace, same revenue per day
        (EXPIRY + 16 * DAY, 30, 30, 2),  # one day late
        (EXPIRY - 10 * DAY, 60, 30, 0),  # early upgrade
        (EXPIRY, 29, 30, 1),
        (EXPIRY, 30, 60, 1),  # same price, twice as long
        (EXPIRY, 30, 0, 1),  # no duration counts as no revenue
        (EXPIRY, None, 30, None),  # unknown revenue is neither more nor less
    ],
)
def test_outcome_of_a_renewed_purchase(mart, renewal, price, days, action):
    rows = mart(purchase("a", 1, START), purchase("a", 2, renewal, price, days))
    assert rows["a-1"].customer_action == action


@pytest.mark.parametrize(("days_since_expiry", "action"), [(15, None), (16, 2)])
def test_outcome_without_renewal_is_open_until_grace_ends(mart, days_since_expiry, action):
    start = AS_OF - (30 + days_since_expiry) * DAY
    assert mart(purchase("a", 1, start))["a-1"].customer_action == action


def test_first_purchase(mart):
    row = mart(purchase("a", 1, START))["a-1"]
    assert (row.purchase_sequence, row.cumulative_ltv) == (1, 0.0)
    assert row.arpu_trend == row.arpu == 1.0
    assert row.gap_days is None
    assert row.supportcallcount_trend is None
    assert row.rolling_3_disruptioncount is None


def test_later_purchases_look_back(mart):
    counts = [4, None, 6, 1, 9]
    starts = [START + 40 * k * DAY for k in range(5)]
    rows = mart(
        *[
            purchase("a", k, s, 10 + k, flowcount=k * k, disruptioncount=c)
            for k, (s, c) in enumerate(zip(starts, counts, strict=True))
        ]
    )
    last = rows["a-4"]
    assert last.purchase_sequence == 5
    assert last.cumulative_ltv == 10 + 11 + 12 + 13
    assert last.gap_days == 10
    assert last.supportcallcount_trend == 16 - 9
    assert last.rolling_3_disruptioncount == pytest.approx((6 + 1) / 2)  # NULL not counted
    assert rows["a-2"].rolling_3_disruptioncount == 4.0


def test_equal_dates_are_ordered_by_id(mart):
    rows = mart(purchase("a", 2, START, 20), purchase("a", 1, START, 10))
    assert [rows[k].purchase_sequence for k in ("a-1", "a-2")] == [1, 2]
    assert rows["a-2"].cumulative_ltv == 10


def test_catalog_price_spans_customers_months_and_null_shapes(mart):
    rows = mart(
        purchase("a", 1, START, 80),
        purchase("b", 1, START + 30 * DAY, 100),  # January 31st
        purchase("c", 1, START + 31 * DAY, 500),  # February
        purchase("d", 1, START, 300, bandwidth=None),
        purchase("e", 1, START, 150, bandwidth=None),
        purchase("f", 1, START, 0, gig_product=1),
        purchase("g", 1, START, 90, productname="Home Static IP"),
        purchase("h", 1, START, 10, productname=None),
    )
    assert rows["a-1"].catalog_price == 100
    assert rows["a-1"].hidden_discount_amount == 20
    assert rows["a-1"].hidden_discount_percentage == pytest.approx(0.2)
    assert rows["e-1"].catalog_price == 300
    assert rows["f-1"].hidden_discount_percentage == 0.0
    assert (rows["g-1"].has_static_ip, rows["g-1"].catalog_price) == (1, 90)
    assert (rows["h-1"].has_static_ip, rows["h-1"].catalog_price) == (0, 100)


def test_schema_and_row_count(spark):
    rows = [purchase("a", k, START + k * DAY) for k in range(4)]
    mart = build_mart(spark.createDataFrame(rows, purchases_schema()), AS_OF)
    found = [(f.name, f.dataType) for f in mart.schema]
    assert found == [(f.name, f.dataType) for f in mart_schema()]
    assert mart.count() == 4


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="price, duration"):
        build_mart(spark.range(1).selectExpr(
            "id username", "id purchaseid", "current_date() purchasedate",
            "current_date() expirationdate", "1 bandwidth", "1 gig_product",
            "'' productname", "1 flowcount", "1 disruptioncount",
        ), AS_OF)
