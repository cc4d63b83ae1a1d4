"""Streams give what batches give, over restarts, repeats and late files."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from tidemark.operators.changes import decode_changes, latest_state, normalize
from tidemark.sources import change_log
from tidemark.streaming import log, state

SCHEMA = StructType([StructField("order_id", StringType(), False), StructField("order_status", StringType())])
FLAT = "order_id string, order_status string, op string, lsn long, ts_ms long, dt date"
DAY = dt.date(2026, 1, 21)


def change(key, lsn, op="u", status=None, day=0):
    return (key, status or f"s{lsn}", op, lsn, 1_768_953_600_000 + lsn * 1000, DAY + dt.timedelta(day))


def deliver(spark, root, rows, table="orders"):
    flat = spark.createDataFrame(rows, FLAT)
    change_log.write_changes(change_log.to_envelope(flat, SCHEMA, table, ["order_id"]), root, table)


def stream(spark, root, max_files=None):
    events = log.read_change_stream(spark, root, "orders", SCHEMA, max_files)
    return normalize(decode_changes(events, SCHEMA), SCHEMA)


def upsert(spark, root, compact_every=2, max_files=1):
    state.upsert_stream(
        stream(spark, root, max_files), f"{root}/state", ["order_id"], f"{root}/checkpoint", None, compact_every
    ).awaitTermination()
    return {(r.order_id, r.lsn) for r in state.read_state(spark, f"{root}/state", ["order_id"]).collect()}


def random_history(seed, n=60):
    draw = random.Random(seed)
    rows = [change(draw.choice("abcdef"), lsn, draw.choice("cuud"), day=draw.randrange(4)) for lsn in range(n)]
    return rows + draw.sample(rows, n // 4)


@pytest.mark.parametrize("compact_every", [1, 2, 100])
def test_upsert_equals_batch_over_restarts(spark, tmp_path, compact_every):
    root, rows = str(tmp_path), random_history(compact_every)
    random.Random(0).shuffle(rows)
    for part in range(3):
        deliver(spark, root, rows[part::3])
        got = upsert(spark, root, compact_every)
    expected = latest_state(spark.createDataFrame(rows, FLAT), ["order_id"]).collect()
    assert got == {(r.order_id, r.lsn) for r in expected}


def test_late_update_after_delete_in_another_batch(spark, tmp_path):
    root = str(tmp_path)
    deliver(spark, root, [change("a", 1, "c"), change("a", 5, "d"), change("b", 2, "c")])
    assert upsert(spark, root) == {("b", 2)}
    deliver(spark, root, [change("a", 3, day=3)])
    assert upsert(spark, root) == {("b", 2)}
    deliver(spark, root, [change("a", 6, "c", day=1)])
    assert upsert(spark, root) == {("b", 2), ("a", 6)}


def test_repeating_a_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path)
    batches = [[change("a", 1), change("b", 2)], [change("a", 3, "d")], [change("c", 4)], [change("b", 5)]]

    def content():
        return {(r.order_id, r.op, r.lsn) for r in state.stored_state(spark, path, ["order_id"]).collect()}

    for number, rows in enumerate(batches):
        for _ in range(2):
            state.apply_batch(spark.createDataFrame(rows, FLAT), number, path, ["order_id"], compact_every=2)
            seen = content()
    assert seen == {("a", "d", 3), ("b", "u", 5), ("c", "u", 4)}
    assert state.finished_folders(spark, f"{path}/base") == [1, 3]
    assert state.finished_folders(spark, f"{path}/delta") == [2, 3]


def test_state_before_the_first_batch(spark, tmp_path):
    with pytest.raises(ValueError):
        state.read_state(spark, str(tmp_path), ["order_id"])


def test_empty_folder_then_files(spark, tmp_path):
    root = str(tmp_path)
    query = log.start(
        stream(spark, root).writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/checkpoint", None
    )
    query.awaitTermination()
    deliver(spark, root, [change("a", 1), change("b", 2)])
    log.start(
        stream(spark, root).writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/checkpoint", None
    ).awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 2


def test_dedupe_across_files(spark, tmp_path):
    root = str(tmp_path)
    source = stream(spark, root, 1).withColumn("event_time", F.timestamp_millis("ts_ms"))
    for _ in range(2):
        deliver(spark, root, [change("a", 1), change("b", 2), change("b", 2)])
        copies = state.dedupe_stream(source, "1 hour", identity=["table", "order_id", "lsn", "op"])
        out = copies.writeStream.format("parquet").option("path", f"{root}/out")
        log.start(out, f"{root}/checkpoint", None).awaitTermination()
        deliver(spark, root, [change("b", 2, day=1), change("c", 3, day=1)])
    log.start(out, f"{root}/checkpoint", None).awaitTermination()
    assert sorted(r.lsn for r in spark.read.parquet(f"{root}/out").collect()) == [1, 2, 3]


def test_copies_are_reduced_before_the_shuffle(spark):
    rows = spark.range(0, 10_000, 1, 2).selectExpr("id % 2 * 9007199254740993 AS lsn", "IF(id % 3 = 0, NULL, 'orders') AS table")
    reduced = rows.mapInArrow(state._first_of_copies(["table", "lsn"]), rows.schema)
    assert reduced.count() <= 8
    assert reduced.distinct().count() == rows.distinct().count() == 4
    assert {r.lsn for r in reduced.collect()} == {0, 9007199254740993}


def test_stateful_aggregate_emits_the_changed_keys(spark, tmp_path):
    root = str(tmp_path)
    emitted = {}

    def keep(batch, batch_id):
        emitted.update({r.order_id: (r.op, r.lsn) for r in batch.collect()})

    def run():
        images = state.latest_image_stream(stream(spark, root), ["order_id"])
        log.start(images.writeStream.outputMode("update").foreachBatch(keep), f"{root}/checkpoint", None).awaitTermination()

    deliver(spark, root, [change("a", 1, "c"), change("a", 4, "d"), change("b", 2, "c")])
    run()
    assert emitted == {"a": ("d", 4), "b": ("c", 2)}
    emitted.clear()
    deliver(spark, root, [change("a", 3), change("c", 7, "c")])
    run()
    assert emitted == {"a": ("d", 4), "c": ("c", 7)}


def test_keyless_stream_keeps_true_duplicates(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        deliver(spark, root, [change("a", 1, "c", "same"), change("a", 2, "c", "same"), change("a", 2, "c", "same")])
        state.append_stream(stream(spark, root, 1), f"{root}/rows", ["lsn", "order_id"], f"{root}/checkpoint", None).awaitTermination()
    rows = state.read_appended(spark, f"{root}/rows").select("order_id", "order_status").collect()
    assert [tuple(r) for r in rows] == [("a", "same")] * 2


def test_log_sink_rolls_files_and_repeats_nothing(spark, tmp_path):
    root = str(tmp_path)
    rows = [change("a", lsn, day=lsn % 2) for lsn in range(50)]
    deliver(spark, root, rows)

    def run():
        events = change_log.route_changes(log.read_change_stream(spark, root, "orders", SCHEMA), "shop").drop("topic")
        log.write_change_log(events, f"{root}/log", f"{root}/sink", interval=None, events_per_file=10).awaitTermination()

    run()
    run()
    stored = log.read_change_log(spark, f"{root}/log", SCHEMA, "orders")
    assert sorted(r.lsn for r in stored.select("source.lsn").collect()) == list(range(50))
    assert len(stored.inputFiles()) >= 6
    assert log.read_change_log(spark, f"{root}/log", SCHEMA, "sellers").count() == 0


def test_delivery_day(spark):
    day = log.with_delivery_day(spark.range(1)).first().dt
    assert abs((day - dt.datetime.now(dt.timezone.utc).date()).days) <= 1


def test_inserts_are_stored_once_however_late_copies_come(spark, tmp_path):
    path, kind = f"{tmp_path}/rows", "op string, lsn long, v string"
    rng = random.Random(6)
    # Positions may be shared by rows of one insert, also across batches, or be missing.
    rows = [("c", rng.randint(0, 600_000), rng.choice("abc")) for _ in range(60)] + [("c", 7, "x"), ("c", None, "y")]
    batches = [rows[i::12] + rng.sample(rows[:: i + 1], min(len(rows[:: i + 1]), 4)) for i in range(12)]
    batches += [batches[0], rows, [("u", 1, "no insert")], []]
    stored = set()
    for number, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, kind)
        for _ in range(1 + number % 2):  # every second batch is repeated
            state.append_batch(frame, number, path, None, compact_every=4)
        stored |= {r for r in batch if r[0] == "c"}
        assert sorted(map(tuple, state.read_appended(spark, path).collect()), key=str) == sorted(stored, key=str)
    plan = state.read_appended(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan
    spans = [tuple(r)[1:] for r in spark.read.parquet(f"{path}/seen/base/000000015").collect()]
    assert all(any(a <= r[1] <= b for a, b in spans) for r in stored if r[1] is not None) and len(spans) < 62


def test_positions_that_meet_are_one_span(spark):
    lsn = [*range(100, 5_000), *range(6_000, 6_010), state.SEEN_SEGMENT - 1, state.SEEN_SEGMENT, 5_000]
    rows = spark.createDataFrame([(x,) for x in lsn] + [(None,)], "lsn long")
    found = sorted(map(tuple, state._islands(state._positions(rows)).collect()))
    last = state.SEEN_SEGMENT - 1
    assert found == [(0, 100, 5_000), (0, 6_000, 6_009), (0, last, last), (1, last + 1, last + 1)]


def test_positions_in_both_are_found_whatever_they_are(spark):
    rng = random.Random(8)
    near = [-70_000, -64, 0, state.SEEN_SEGMENT - 40, 5 * 10**12, 2**62]
    sides = [{start + rng.randint(-90, 90) for start in near for _ in range(150)} | set(range(1_000, 1_400)) for _ in range(2)]
    sides[1] = {p for p in sides[1] if not 1_100 <= p < 1_110}
    spans = []
    for side in sides:
        rows = spark.createDataFrame([(p,) for p in side for _ in range(1 + p % 2)] + [(None,)], "lsn long")
        spans.append(state._islands(state._positions(rows)))
        assert sorted(p for r in spans[-1].collect() for p in range(r["first"], r["last"] + 1)) == sorted(side)
    common = [p for r in state._common(*spans).collect() for p in range(r["first"], r["last"] + 1)]
    assert set(common) == sides[0] & sides[1]


def test_positions_with_gaps_everywhere_are_looked_up_in_linear_time(spark, tmp_path):
    """Compared row by span, the second batch makes 1.7e10 comparisons in one segment."""
    n, took = state.SEEN_SEGMENT, []
    for number in range(3):
        # Even positions, odd ones, then all of them again.
        rows = spark.range(number % 2, n, 1 + (number < 2), 8).selectExpr("'c' AS op", "id AS lsn", "id % 7 AS v")
        began = time.monotonic()
        state.append_batch(rows, number, f"{tmp_path}/rows", None)
        took.append(time.monotonic() - began)
        stored = state.read_appended(spark, f"{tmp_path}/rows")
        assert stored.count() == stored.distinct().count() == min(n, (number + 1) * n // 2)
    assert max(took[1:]) < 10 + 5 * took[0], took


def test_a_batch_that_broke_off_leaves_no_row_at_an_unseen_position(spark, tmp_path, monkeypatch):
    path, rows = f"{tmp_path}/rows", [spark.createDataFrame([("c", n, "v")], "op string, lsn long, v string") for n in range(2)]
    state.append_batch(rows[0], 0, path, None)

    def fail(spans):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(state, "_islands", fail)
        with pytest.raises(RuntimeError):
            state.append_batch(rows[1], 1, path, None)
    # Another checkpoint goes on after whatever was finished.
    state.append_batch(rows[1], 2, path, None)
    assert sorted(r.lsn for r in state.read_appended(spark, path).collect()) == [0, 1]


def test_copies_that_differ_in_position_are_stored_once(spark, tmp_path):
    for number, rows in enumerate([[("c", 1, "a"), ("c", 2, "b")], [("c", 3, "a"), ("r", 4, "c"), ("c", 5, "c"), ("c", None, "b")]]):
        state.append_batch(spark.createDataFrame(rows, "op string, lsn long, v string"), number, f"{tmp_path}/rows", ["V"])
    assert sorted(r.v for r in state.read_appended(spark, f"{tmp_path}/rows").collect()) == ["a", "b", "c"]
