"""Prices as of a time, changes of tables without key, samples."""

import datetime as dt
import random
from collections import Counter

import pytest

from tidemark.operators import changes as cdc
from tidemark.operators import select

ITEMS = "order_id string, order_item_id int, product_id string, shipping_limit_date timestamp_ntz, price double"
DAY = dt.datetime(2026, 1, 1)


def as_of(items, product, at):
    found = [
        (when, order, number, price)
        for order, number, p, when, price in items
        if p is not None and p == product and when is not None and price is not None and at is not None and when < at
    ]
    return max(found)[3] if found else 1.5


@pytest.mark.parametrize("segment_seconds", [86_400, 3_600, 10**9])
def test_price_as_of_equals_brute_force(spark, segment_seconds):
    rng = random.Random(4)

    def moment():
        # Coarse, so that many times are equal; before 1970 too.
        return rng.choice([None, *[DAY + dt.timedelta(hours=rng.randint(-600_000, -599_900)) for _ in range(3)]] +
                          [DAY + dt.timedelta(minutes=30 * rng.randint(0, 200)) for _ in range(20)])

    # One product has most rows.
    product = lambda: rng.choice(["hot"] * 6 + ["b", "c", None])
    items = [
        (f"o{rng.randint(0, 40)}", rng.randint(1, 3), product(), moment(), rng.choice([None, rng.randint(1, 99) / 4]))
        for _ in range(400)
    ]
    requests = [(i, product(), moment(), "mine") for i in range(300)]
    asked = spark.createDataFrame(requests, "id int, product_id string, at timestamp_ntz, _segment string")
    offered = spark.createDataFrame(items, ITEMS)
    found = select.price_as_of(asked, offered, 1.5, segment_seconds=segment_seconds)
    assert found.columns == ["id", "product_id", "at", "_segment", "price"]
    expected = [(i, p, at, mine, as_of(items, p, at)) for i, p, at, mine in requests]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


@pytest.mark.parametrize("hot_rows", [0, 30, 100, 10**6])
def test_prices_of_hot_products_are_carried_over_segments(spark, hot_rows):
    rng = random.Random(6)

    def moment():
        return rng.choice([None, *[DAY + dt.timedelta(hours=6 * rng.randint(-200, 200)) for _ in range(20)]])

    product = lambda: rng.choice(["hot"] * 6 + ["warm", "cold", None])
    items = [(f"o{rng.randint(0, 40)}", rng.randint(1, 3), product(), moment(), rng.choice([None, rng.randint(1, 99) / 4])) for _ in range(300)]
    asked = [(None if i % 9 == 0 else i, product(), moment()) for i in range(200)]
    found = select.price_as_of(
        spark.createDataFrame(asked, "id int, product_id string, when timestamp_ntz"),
        spark.createDataFrame(items, ITEMS), 1.5, at="when", hot_rows=hot_rows,
    )
    assert found.columns == ["id", "product_id", "when", "price"]
    expected = Counter((i, p, when, as_of(items, p, when)) for i, p, when in asked)
    assert Counter(map(tuple, found.collect())) == expected


def test_rows_of_common_products_are_shuffled_once(spark, tmp_path):
    rows = spark.range(3_000).selectExpr(
        "CAST(id AS STRING) AS order_id", "1 AS order_item_id", "CAST(id % 70 AS STRING) AS product_id",
        "TIMESTAMP_NTZ '2026-01-01 00:00:00' + make_dt_interval(CAST(id AS INT)) AS shipping_limit_date", "CAST(id AS DOUBLE) AS price",
    )
    rows.write.parquet(f"{tmp_path}/rows")
    items = spark.read.parquet(f"{tmp_path}/rows")
    found = select.price_as_of(items.withColumnRenamed("shipping_limit_date", "at").drop("price"), items, 1.5)
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Without hot products, only the window is left of the plan.
    assert final.count("Exchange hashpartitioning(product_id") == 1, final


def test_first_items_and_equal_times_see_no_price(spark):
    items = spark.createDataFrame([("o", 1, "p", DAY, 5.0), ("o", 2, "p", DAY + dt.timedelta(days=40), 7.0)], ITEMS)
    times = [DAY, DAY + dt.timedelta(microseconds=1), DAY + dt.timedelta(days=40), DAY + dt.timedelta(days=400)]
    asked = spark.createDataFrame([("p", t) for t in times], "product_id string, at timestamp_ntz")
    found = {r.at: r.price for r in select.price_as_of(asked, items, 1.5).collect()}
    assert [found[t] for t in times] == [1.5, 5.0, 5.0, 7.0]
    assert select.price_as_of(asked.limit(0), items, 1.5).count() == 0
    assert {r.price for r in select.price_as_of(asked, items.limit(0), 1.5).collect()} == {1.5}


def test_differences_count_rows(spark):
    rng = random.Random(9)
    kinds = [("a", 1), ("a", None), (None, None), ("b", 2), ("c", 3)]
    old, new = (
        [*rng.choices(kinds, k=40), *[("hot", 0)] * n] for n in (300, 200)
    )
    frames = [spark.createDataFrame(rows, "s string, n int") for rows in (old, new)]
    changes = cdc.multiset_diff(*frames)
    rows = changes.collect()
    gone, made = Counter(old) - Counter(new), Counter(new) - Counter(old)
    assert Counter(tuple(r.before) for r in rows if r.op == "d") == gone
    assert Counter(tuple(r.after) for r in rows if r.op == "c") == made
    assert all((r.before is None) == (r.op == "c") and (r.after is None) == (r.op == "d") for r in rows)
    assert Counter(map(tuple, cdc.apply_multiset(frames[0], changes).collect())) == Counter(new)
    assert cdc.multiset_diff(frames[0], frames[0]).count() == 0
    assert cdc.multiset_diff(frames[0].limit(0), frames[1]).count() == len(new)


def test_copies_are_summed_before_the_shuffle(spark):
    frame = spark.range(1000).selectExpr("id % 2 as n")
    plan = cdc.multiset_diff(frame, frame.limit(10))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")


def test_rows_without_key_are_sampled_too(spark):
    rows = spark.createDataFrame([(None,), ("a",)], "k string")
    assert select.sample_rows(rows, 100, 1, "k").count() == 2
    drawn = [select.sample_rows(rows.where("k is null"), 50, seed, "k").count() for seed in range(12)]
    assert set(drawn) == {0, 1}
