"""Quality rules, with failures and without."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.schemas import get_schema


def result(df):
    return {r.rule: (r.checked, r.failed) for r in df.collect()}


def test_unique_counts_keys_and_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert result(quality.check_unique(df, "t", ["a", "b"])) == {"unique a, b": (2, 1)}


def test_row_rules_report_zero_failures(spark):
    df = spark.createDataFrame([("s1", 1, "x" * 65, None), ("s2", 1, "é" * 64, "b")], get_schema("sellers"))
    assert result(quality.check_length(df, "sellers", {"seller_city": 64, "seller_state": 64})) == {
        "length seller_city <= 64": (2, 1),
        "length seller_state <= 64": (2, 0),
    }
    assert result(quality.check_required(df, "sellers", get_schema("sellers"))) == {"required seller_id": (2, 0)}
    assert quality.check_rows(df, "sellers", {}).count() == 0
    assert result(quality.check_rows(df.limit(0), "sellers", {"r": F.col("seller_id").isNull()})) == {"r": (0, 0)}


def test_foreign_key_null_passes_and_rows_are_counted(spark):
    child = spark.createDataFrame([("a",), ("a",), ("x",), ("x",), ("x",), (None,)], "ref string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    assert result(quality.check_fk(child, "c", "ref", parent, "p", "id")) == {"ref in p": (5, 3)}
    assert result(quality.check_fk(child.limit(0), "c", "ref", parent, "p", "id")) == {"ref in p": (0, 0)}


def test_validate_table(spark):
    spark.createDataFrame([("s1", 1, "a", "b")], get_schema("sellers")).createOrReplaceTempView("v_sellers")
    assert result(quality.validate_table(spark, "v_sellers", get_schema("sellers"))) == {
        "present": (1, 0), "schema": (1, 0), "not empty": (1, 0)
    }
    spark.createDataFrame([], get_schema("sellers")).createOrReplaceTempView("v_empty")
    assert result(quality.validate_table(spark, "v_empty", get_schema("orders"))) == {
        "present": (1, 0), "schema": (1, 1), "not empty": (0, 1)
    }
    assert result(quality.validate_table(spark, "v_absent", get_schema("orders")))["present"] == (1, 1)


LOG = "order_id string, lsn long, order_status string"


def steps(*statuses, order_id="o", start=1):
    return [(order_id, start + i, s) for i, s in enumerate(statuses)]


@pytest.mark.parametrize("segment", [1, 2, 3, 1 << 24])
def test_life_cycle(spark, segment):
    log = spark.createDataFrame(
        steps("created", "approved", "processing", "invoiced", "shipped", "delivered", order_id="fine")
        + steps("created", "canceled", order_id="canceled")
        + steps("approved", "shipped", order_id="bad start and skip")
        + steps("created", "approved", "processing", "invoiced", "shipped", "canceled", order_id="late cancel")
        + steps("created", None, "created", order_id="null"),
        LOG,
    )
    found = {(r.order_id, r.lsn, r.previous_status, r.status, r.is_first) for r in quality.illegal_transitions(log, segment=segment).collect()}
    assert found == {
        ("bad start and skip", 1, None, "approved", True),
        ("bad start and skip", 2, "approved", "shipped", False),
        ("late cancel", 6, "shipped", "canceled", False),
        ("null", 2, "created", None, False),
        ("null", 3, None, "created", False),
    }


@pytest.mark.parametrize("segment", [1, 7, 64, 1000])
def test_previous_value_equals_a_plain_walk(spark, segment):
    draw = random.Random(segment)
    log = [(draw.choice("aab"), lsn, draw.choice(["x", "y", None])) for lsn in draw.sample(range(1000), 300)]
    last, expected = {}, {}
    for key, lsn, value in sorted(log, key=lambda r: r[1]):
        expected[lsn] = last.get(key)
        last[key] = (value,)
    got = quality.with_previous(spark.createDataFrame(log, "k string, lsn long, v string"), "k", "v", segment=segment)
    assert {r.lsn: None if r.previous is None else (r.previous.v,) for r in got.collect()} == expected


def test_item_sequence(spark):
    df = spark.createDataFrame(
        [("ok", 1), ("ok", 2), ("gap", 1), ("gap", 3), ("twice", 1), ("twice", 1), ("zero", 0), ("zero", 1), ("null", None)],
        "order_id string, order_item_id int",
    )
    assert result(quality.check_item_sequence(df)) == {"item numbers contiguous": (5, 4)}


def test_mix_keeps_values_and_targets_without_counterpart(spark):
    df = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "v string")
    got = {r.value: (r.n, r.share, r.target) for r in quality.mix_profile(df, "v", {"a": 3, "b": 1}).collect()}
    assert got == {"a": (2, 0.5, 0.75), "b": (0, 0.0, 0.25), "z": (1, 0.25, None), None: (1, 0.25, None)}
    customers = spark.createDataFrame([("u1",), ("u1",), ("u1",), ("u2",)], "customer_unique_id string")
    mix = quality.mix_profile(quality.returning_buyers(customers), "returning", {True: 85, False: 15}, weight="n")
    assert {r.value: (r.n, r.target) for r in mix.collect()} == {"true": (2, 0.85), "false": (2, 0.15)}


def test_steps_that_cancel(spark):
    rows = [("a", 1, "created"), ("a", 2, "created"), ("a", 3, "canceled"), ("b", 1, "created"), ("b", 2, "approved"),
            ("b", 9, "canceled"), ("c", 1, "shipped"), ("c", 2, "canceled"), ("d", 1, None), ("d", 2, "created")]
    log = spark.createDataFrame(rows, "order_id string, lsn long, order_status string")
    assert sorted(r.cancelled for r in quality.cancelled_steps(log, segment=2).collect()) == [False, True, True]


def test_delivered_orders_with_a_review(spark):
    orders = spark.createDataFrame([("a", "delivered"), ("b", "delivered"), ("c", "shipped")], "order_id string, order_status string")
    reviews = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "order_id string")
    assert sorted(r.reviewed for r in quality.reviewed_orders(orders, reviews).collect()) == [False, True]
