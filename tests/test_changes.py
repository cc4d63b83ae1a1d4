"""Change-log rules on small literal frames, and laws between operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.changes import (
    after_bookmark,
    append_only_state,
    current_state,
    decode_changes,
    dedupe_changes,
    latest_image,
    latest_state,
    live,
    merge_batch,
    normalize,
    snapshot_as_of,
    snapshot_diff,
    unify,
)
from tidemark.schemas import get_schema
from tidemark.sources.change_log import envelope_schema, to_envelope

LOG = "key long, op string, lsn long, status string"


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


@pytest.fixture
def history(spark):
    """Key 1: insert, two updates, delete, insert again. Key 2: deleted. Key 3: updated."""
    return spark.createDataFrame(
        [
            (1, "c", 10, "created"),
            (1, "u", 20, "approved"),
            (1, "u", 30, "processing"),
            (1, "d", 40, None),
            (1, "c", 50, "created"),
            (2, "c", 11, "created"),
            (2, "d", 12, None),
            (3, "u", 15, "shipped"),
        ],
        LOG,
    )


def test_latest_state(history):
    assert rows(latest_state(history, ["key"]), "key", "lsn", "status") == [(1, 50, "created"), (3, 15, "shipped")]


def test_latest_state_ignores_order_and_copies(history):
    shuffled = history.unionAll(history).orderBy(F.desc("lsn"))
    assert rows(latest_state(shuffled, ["key"])) == rows(latest_state(history, ["key"]))


def test_composite_key(spark):
    log = spark.createDataFrame(
        [("a", 1, "c", 1, "x"), ("a", 2, "c", 2, "y"), ("a", 1, "u", 3, "z")],
        "k1 string, k2 int, op string, lsn long, status string",
    )
    assert rows(latest_state(log, ["k1", "k2"]), "k1", "k2", "status") == [("a", 1, "z"), ("a", 2, "y")]


@pytest.mark.parametrize("seed", range(3))
def test_merge_in_batches_equals_one_merge(spark, history, seed):
    events = [tuple(r) for r in history.collect()] * 2
    random.Random(seed).shuffle(events)
    state = latest_image(spark.createDataFrame(events[:5], LOG), ["key"])
    for start in range(5, len(events), 5):
        state = merge_batch(state, spark.createDataFrame(events[start : start + 5], LOG), ["key"])
    assert rows(live(state)) == rows(latest_state(history, ["key"]))


def test_older_update_does_not_revive_a_deleted_key(spark, history):
    state = latest_image(history, ["key"])
    late = spark.createDataFrame([(2, "u", 11, "approved")], LOG)
    assert rows(live(merge_batch(state, late, ["key"])), "key") == [(1,), (3,)]


def test_merge_keeps_columns_the_batch_has_in_another_order(spark, history):
    state = latest_image(history, ["key"])
    batch = spark.createDataFrame([("approved", 60, "u", 1)], "status string, lsn long, op string, key long")
    assert rows(live(merge_batch(state, batch, ["key"])), "key", "status") == [(1, "approved"), (3, "shipped")]


def test_change_below_the_bookmark_counts_and_old_epoch_does_not(spark):
    snapshot = spark.createDataFrame([(1, "snap"), (2, "snap"), (4, "snap")], "key long, status string")
    changes = spark.createDataFrame(
        [(1, "u", 90, "stale", 1), (1, "u", 5, "fresh", 2), (2, "u", 95, "stale", 1), (4, "d", 3, None, 2)],
        LOG + ", epoch int",
    )
    current = after_bookmark(changes, 2)
    assert rows(current_state(snapshot, current, ["key"])) == [(1, "fresh"), (2, "snap")]


def test_current_state_equals_latest_state_of_the_union(spark, history):
    snapshot = spark.createDataFrame([(1, "old"), (2, "old"), (9, "old")], "key long, status string")
    direct = current_state(snapshot, history, ["key"])
    by_union = latest_state(unify(snapshot, history), ["key"])
    assert rows(direct) == rows(by_union, "key", "status") == [(1, "created"), (3, "shipped"), (9, "old")]


def test_snapshot_as_of_takes_changes_up_to_the_position(spark, history):
    snapshot = spark.createDataFrame([(2, "old"), (3, "old")], "key long, status string")
    assert rows(snapshot_as_of(snapshot, history, ["key"], 12)) == [(1, "created"), (3, "old")]
    assert rows(snapshot_as_of(snapshot, history, ["key"], F.lit(30))) == [(1, "processing"), (3, "shipped")]


def test_diff_applied_to_the_old_state_gives_the_new_one(spark):
    schema = "key long, status string, value double"
    old = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, "c", None), (4, "d", 4.0)], schema)
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None), (5, None, None)], schema)
    diff = snapshot_diff(old, new, ["key"])
    assert rows(diff, "key", "op") == [(2, "u"), (4, "d"), (5, "c")]
    changes = diff.select(
        "key",
        *(F.coalesce(f"after.{c}", f"before.{c}").alias(c) for c in ("status", "value")),
        "op",
        F.lit(1).cast("long").alias("lsn"),
    )
    applied = {r.key: r for r in current_state(old, changes, ["key"]).collect()}
    assert applied == {r.key: r for r in new.collect()}
    assert snapshot_diff(new, new, ["key"]).count() == 0


def test_dedupe_keeps_the_first_delivery(spark):
    day = dt.date(2026, 1, 21)
    log = spark.createDataFrame(
        [
            ("orders", "a", 1, "u", day + dt.timedelta(1)),
            ("orders", "a", 1, "u", day),
            ("orders", "a", 1, "d", day),
            ("orders", "b", 1, "u", day),
            ("sellers", "a", 1, "u", day),
        ],
        "table string, key string, lsn long, op string, dt date",
    )
    kept = rows(dedupe_changes(log))
    assert len(kept) == 4 and ("orders", "a", 1, "u", day) in kept


def test_keyless_duplicates_stay_and_redeliveries_go(spark):
    snapshot = spark.createDataFrame([("o1", 5.0)], "order_id string, payment_value double")
    changes = spark.createDataFrame(
        [("o1", 5.0, 7, "c"), ("o1", 5.0, 8, "c"), ("o1", 5.0, 8, "c"), ("o2", 1.0, 8, "c")],
        "order_id string, payment_value double, lsn long, op string",
    )
    assert rows(append_only_state(snapshot, changes)) == [("o1", 5.0)] * 3 + [("o2", 1.0)]


def test_decode_takes_each_column_from_the_image_that_has_it(spark):
    schema = get_schema("sellers")
    source = (1, 1, 1, "public", "sellers")
    events = spark.createDataFrame(
        [
            ("c", 1, None, ("s1", 1000, "Recife", "PE"), source),
            ("u", 2, ("s1", 1000, "Recife", "PE"), ("s1", 2000, None, "PE"), source),
            ("d", 3, ("s2", None, None, None), None, source),
            ("r", 4, None, ("s3", 3000, "Natal", "RN"), source),
            (None, None, None, None, None),
        ],
        envelope_schema(schema),
    )
    got = {(r.seller_id, r.op, r.seller_zip_code_prefix, r.seller_city) for r in decode_changes(events, schema).collect()}
    assert got == {
        ("s1", "c", 1000, "Recife"),
        ("s1", "u", 2000, None),
        ("s2", "d", None, None),
        ("s3", "r", 3000, "Natal"),
    }


def test_wire_round_trip_of_every_order_column(spark):
    schema = get_schema("orders")
    meta = StructType().add("op", "string").add("lsn", "long").add("ts_ms", "long")
    moment = dt.datetime(2026, 1, 21, 23, 59, 59, 123456)
    order = ("o1", "c1", "created", moment, None, None, None, dt.datetime(1969, 12, 31, 1, 2, 3, 4))
    flat = spark.createDataFrame([(*order, "c", 5, 6)], StructType(schema.fields + meta.fields))
    events = to_envelope(flat, schema, "orders", ["order_id"])
    assert tuple(normalize(decode_changes(events, schema), schema).first())[:8] == order


def test_normalize_names_times_and_numbers(spark):
    raw = spark.createDataFrame(
        [("s1", "1000", "extra"), ("s2", "oops", "extra")], "SELLER_ID string, seller_zip_code_prefix string, note string"
    )
    assert rows(normalize(raw, get_schema("sellers")).na.fill("-").na.fill(-1)) == [
        ("s1", 1000, "-", "-", "extra"),
        ("s2", -1, "-", "-", "extra"),
    ]
    times = spark.createDataFrame(
        [("1768953599123456",), ("2026-01-20T23:59:59.123456",), ("2026-01-20 23:59:59.123456",), ("soon",)],
        "shipping_limit_date string",
    )
    got = [r.shipping_limit_date for r in normalize(times, get_schema("order_items")).collect()]
    assert got == [dt.datetime(2026, 1, 20, 23, 59, 59, 123456)] * 3 + [None]
