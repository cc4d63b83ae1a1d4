"""Reference data, order transitions, selections, gold measures."""

import datetime as dt

import pytest

from tidemark.functions import next_status
from tidemark.operators import gold, select, silver
from tidemark.schemas import get_schema

DAY = dt.datetime(2026, 1, 1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_geolocation_ties_are_settled_by_name(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 2.0, "b", "X"), (1, 3.0, 4.0, "a", "X"), (1, None, 6.0, "b", "X"), (1, 5.0, 8.0, "a", "X"), (2, None, None, None, None)],
        get_schema("geolocation"),
    )
    assert sorted(rows(silver.geolocation_unique(df)), key=lambda r: r[0]) == [(1, 3.0, 5.0, "a", "X"), (2, None, None, None, None)]


def test_translation_keeps_unknown_and_null(spark):
    products = spark.createDataFrame([("p1", "LARGE"), ("p2", "ODD"), ("p3", None)], "product_id string, product_category_name string")
    words = spark.createDataFrame([("LARGE", "large")], get_schema("product_category_name_translation"))
    assert rows(silver.translate_category(products, words)) == [("p1", "large"), ("p2", "ODD"), ("p3", None)]


def test_unknown_places_get_the_default(spark):
    places = spark.createDataFrame([(5, 0.0, 0.0, "Recife", None)], get_schema("geolocation"))
    df = spark.createDataFrame([("c1", 5), ("c2", 6), ("c3", None)], "customer_id string, zip int")
    assert rows(silver.place_or_default(df, places, "zip")) == [
        ("c1", 5, 5, "Recife", None),
        ("c2", 6, 10000, "Sao Paulo", "SP"),
        ("c3", None, 10000, "Sao Paulo", "SP"),
    ]


@pytest.mark.parametrize(
    "status, cancel, expected",
    [
        ("created", False, "approved"),
        ("invoiced", False, "shipped"),
        ("shipped", False, "delivered"),
        ("delivered", False, "delivered"),
        ("canceled", False, "canceled"),
        ("created", True, "canceled"),
        ("shipped", True, "delivered"),
        ("delivered", True, "delivered"),
        ("unavailable", False, "unavailable"),
        ("unavailable", True, "canceled"),
    ],
)
def test_next_status(spark, status, cancel, expected):
    df = spark.createDataFrame([(status, cancel)], "s string, c boolean")
    assert df.select(next_status("s", df.c)).first()[0] == expected


def order(order_id, status):
    return (order_id, "c", status, DAY, None, None, None, DAY)


def test_transitions_step_by_step(spark):
    orders = spark.createDataFrame(
        [order(i, s) for i, s in [("a", "created"), ("b", "processing"), ("c", "shipped"), ("d", "created"), ("e", "created")]], get_schema("orders")
    )
    at = [DAY + dt.timedelta(hours=h) for h in range(10)]
    events = [("a", h, at[h], False) for h in range(9, 0, -1)]
    events += [("b", 1, at[1], False), ("b", 2, at[2], True), ("b", 3, at[3], False)]
    events += [("c", 1, at[1], True)]
    events += [("e", 1, None, False), ("e", 2, at[2], None)]
    result = silver.apply_transition(
        orders, spark.createDataFrame(events, "order_id string, lsn long, at timestamp_ntz, cancel boolean")
    )
    got = {r.order_id: (r.order_status, r.order_approved_at, r.order_delivered_carrier_date, r.order_delivered_customer_date) for r in result.collect()}
    assert got == {
        "a": ("delivered", at[1], at[4], at[5]),
        "b": ("canceled", None, None, None),
        "c": ("delivered", None, None, at[1]),
        "d": ("created", None, None, None),
        "e": ("processing", None, None, None),
    }


def test_price_of_the_latest_item_or_default(spark):
    items = spark.createDataFrame(
        [("o1", 1, "p1", "s", DAY, 1.0, 0.0), ("o2", 1, "p1", "s", DAY + dt.timedelta(1), 2.0, 0.0), ("o2", 1, "p1", "s", DAY + dt.timedelta(1), 3.0, 0.0)],
        get_schema("order_items"),
    )
    products = spark.createDataFrame([("p1",), ("p2",)], "product_id string")
    assert rows(select.price_or_default(items, products, 9.5)) == [("p1", 3.0), ("p2", 9.5)]


def test_selections(spark):
    df = spark.createDataFrame([("a", "delivered"), ("b", None), ("c", "created")], "order_id string, order_status string")
    assert rows(select.open_orders(df)) == [("c", "created")]
    assert rows(select.lookup(df, "order_id", "b")) == [("b", None)]
    assert select.lookup(df, "order_status", None).count() == 0
    assert rows(select.first_rows(df, 2, "order_id")) == [("a", "delivered"), ("b", None)]
    with pytest.raises(ValueError):
        select.first_rows(df, 2)
    assert select.project(df).columns == df.columns


def test_random_top_does_not_depend_on_partitions(spark):
    df = spark.range(1000)
    once = rows(select.random_top(df.repartition(3), 10, 1, "id"))
    assert once == rows(select.random_top(df.repartition(11), 10, 1, "id")) and len(once) == 10
    assert once != rows(select.random_top(df, 10, 2, "id"))
    assert select.random_top(df, 10, 1).count() == 10
    assert 0 <= select.sample_rows(df, 1, 5).count() < 100


def test_reconciliation_outcomes(spark):
    items = spark.createDataFrame(
        [("o1", 1, "p", "s", DAY, 0.1, 0.2), ("o1", 2, "p", "s", DAY, 0.7, None), ("o2", 1, "p", "s", DAY, 5.0, 0.0), ("o3", 1, "p", "s", DAY, 1.0, 1.0)],
        get_schema("order_items"),
    )
    payments = spark.createDataFrame(
        [("o1", 1, "voucher", 1, 0.5), ("o1", 2, "boleto", 1, 0.51), ("o2", 1, "boleto", 1, 5.02), ("o4", 1, "boleto", 1, 1.0)],
        get_schema("payments"),
    )
    got = {r.order_id: (r.items, r.outcome) for r in gold.reconcile_payments(items, payments).collect()}
    assert got == {"o1": (2, "match"), "o2": (1, "mismatch"), "o3": (1, "no payment"), "o4": (0, "no items")}


def test_item_fact_keeps_its_grain_and_fans_out_nothing(spark):
    items = spark.createDataFrame([("o1", 1, "p", "s", DAY, 0.1, 0.2)] * 3, get_schema("order_items"))
    orders = spark.createDataFrame([order("o1", "created")], get_schema("orders"))
    customers = spark.createDataFrame([("c", "u", 1, "x", "y")], get_schema("customers"))
    fact = gold.fact_order_items(items, orders, customers).collect()
    assert len(fact) == 3 and str(fact[0].price_and_freight) == "0.30" and fact[0].customer_unique_id == "u"
    assert fact[0].purchase_date_key == 20260101


def test_date_dimension_covers_every_order_date(spark):
    late = DAY + dt.timedelta(days=4)
    orders = spark.createDataFrame([("o", "c", "delivered", DAY, None, None, late, None)], get_schema("orders"))
    dates = gold.dim_date(orders).orderBy("date_key").collect()
    assert [d.date_key for d in dates] == [20260101, 20260102, 20260103, 20260104, 20260105]
    assert [d.is_weekend for d in dates] == [False, False, True, True, False]
    assert (dates[0].weekday, dates[0].iso_week, dates[0].quarter) == (4, 1, 1)
    assert gold.dim_date(orders.limit(0)).count() == 0


def test_durations_need_both_milestones(spark):
    orders = spark.createDataFrame(
        [("o", "c", "delivered", DAY, DAY + dt.timedelta(minutes=119), None, DAY + dt.timedelta(days=2), DAY + dt.timedelta(days=1))],
        get_schema("orders"),
    )
    assert rows(gold.order_durations(orders)) == [("o", 1, None, None, 48, 24, True)]
