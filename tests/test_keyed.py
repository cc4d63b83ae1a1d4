"""State in the engine gives what batches give, over restarts, copies and late changes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import decode_changes, latest_state, normalize
from tidemark.sources import change_log
from tidemark.streaming import keyed, log

SCHEMA = T.StructType([T.StructField("order_id", T.StringType(), False), T.StructField("order_status", T.StringType())])
FLAT = "order_id string, order_status string, op string, lsn long, ts_ms long, dt date"
DAY = dt.date(2026, 1, 21)
STATUSES = ("created", "approved", "processing", "shipped", "canceled", None)


def history(seed, n=80):
    draw = random.Random(seed)
    return [
        (draw.choice("abcde"), draw.choice(STATUSES), draw.choice("cuuuud"), lsn, lsn * 1000, DAY) for lsn in range(n)
    ]


def deliver(spark, root, rows):
    events = change_log.to_envelope(spark.createDataFrame(rows, FLAT), SCHEMA, "orders", ["order_id"])
    change_log.write_changes(events, root, "orders")


def run(spark, root, transform, name):
    events = log.read_change_stream(spark, root, "orders", SCHEMA)
    rows = transform(normalize(decode_changes(events, SCHEMA), SCHEMA))
    writer = rows.writeStream.format("parquet").option("path", f"{root}/{name}")
    keyed.start_keyed(writer, f"{root}/{name}-checkpoint", None).awaitTermination()
    return spark.read.parquet(f"{root}/{name}")


def illegal(rows):
    """Steps between neighbours, by a plain walk."""
    chain = ["created", "approved", "processing", "invoiced", "shipped", "delivered"]
    legal = {(None, "created"), *zip(chain, chain[1:]), *((s, "canceled") for s in chain[:4])}
    found, last = set(), {}
    for key, status, op, lsn, *_ in sorted(set(rows), key=lambda r: r[3]):
        is_first, previous = last.get(key, (True, None))
        if op == "d":
            last[key] = (True, None)
            continue
        if (not is_first and previous is None) or (previous, status) not in legal:
            found.add((key, lsn, previous, status, is_first))
        last[key] = (False, status)
    return found


@pytest.mark.parametrize("seed", [1])
def test_equal_to_batches_over_restarts_copies_and_late_changes(spark, tmp_path, seed):
    root, rows = str(tmp_path), history(seed)
    shuffled = rows + rows[::3]
    random.Random(seed).shuffle(shuffled)
    for part in range(3):
        deliver(spark, root, shuffled[part::3])
        images = run(spark, root, lambda s: keyed.newest_images(s, "order_id"), "images")
        steps = run(spark, root, keyed.watch_life_cycles, "steps")
    newest = {(r.order_id, r.lsn) for r in latest_state(images, ["order_id"]).collect()}
    expected = latest_state(spark.createDataFrame(rows, FLAT), ["order_id"]).collect()
    assert newest == {(r.order_id, r.lsn) for r in expected}
    assert {tuple(r) for r in keyed.settled_steps(steps).collect()} == illegal(rows)
    assert steps.where("weight < 0").count(), "no step was parted, the test is too easy"


class Store:
    """One key's state, and the calls made to it."""

    def __init__(self):
        self.values, self.calls, self.owner = {}, 0, self

    def getValueState(self, name, *schemas):  # noqa: N802
        part = Store()
        part.owner = self
        return part

    getMapState = getValueState  # noqa: N815

    def get(self):
        return self.getValue(None)

    def update(self, value):
        self.updateValue(None, value)

    def getValue(self, key):  # noqa: N802
        self.owner.calls += 1
        return self.values.get(key)

    def containsKey(self, key):  # noqa: N802
        self.owner.calls += 1
        return key in self.values

    def keys(self):
        self.owner.calls += 1
        return iter([k for k in self.values if k is not None])

    def updateValue(self, key, value):  # noqa: N802
        self.owner.calls += 1
        self.values[key] = value


@pytest.mark.parametrize("chunk", [1, 2, 5, None])
def test_histories_in_chunks_equal_the_batch_rule(chunk):
    columns = ["order_id", "lsn", "previous_status", "status", "is_first", "weight"]
    processor, store = keyed.LifeCycle(columns, *([chunk] if chunk else [])), Store()
    processor.init(store)
    rows = [r for r in history(11) if r[0] is not None]
    rows = [("a", *r[1:]) for r in rows]
    shuffled, weights = [*rows, *rows[::5]], {}
    random.Random(2).shuffle(shuffled)
    for n in range(0, len(shuffled), 7):
        batch = [{"position": r[3], "status": r[1], "gone": r[2] == "d"} for r in shuffled[n : n + 7]]
        for found in processor.handleInputRows(("a",), iter(batch), None):
            weights[tuple(found)[:-1]] = weights.get(tuple(found)[:-1], 0) + found[-1]
    assert set(weights.values()) <= {0, 1}
    assert {r for r, w in weights.items() if w} == illegal(rows)
    # A change costs no call of its own: without the chunk size, two a batch.
    assert chunk or store.calls <= 2 * -(-len(shuffled) // 7)


def test_a_deleted_key_is_not_revived(spark, tmp_path):
    root = str(tmp_path)
    for rows in ([("a", "created", "c", 1), ("a", None, "d", 5)], [("a", "approved", "u", 3)], [("a", "created", "c", 9)]):
        deliver(spark, root, [(*r, 0, DAY) for r in rows])
        images = run(spark, root, lambda s: keyed.newest_images(s, "order_id"), "images")
    assert sorted((r.lsn, r.op) for r in images.collect()) == [(5, "d"), (9, "c")]


LINES = "table string, dt date, lsn long, line string"


def numbered(spark, sizes, max_bytes, max_events=10_000, segment=8):
    rows = [("t", DAY, n, "x" * (size - 1)) for n, size in enumerate(sizes)]
    found = log.number_files(spark.createDataFrame(rows, LINES), max_bytes, max_events, segment)
    return [(r.file, len(r.line) + 1) for r in found.orderBy("lsn").collect()]


@pytest.mark.parametrize("max_events", [7, 10_000])
def test_files_keep_to_both_limits(spark, max_events):
    draw = random.Random(max_events)
    sizes = [draw.randrange(1, 60) for _ in range(300)]
    files = {}
    for file, size in numbered(spark, sizes, 100, max_events):
        files.setdefault(file, []).append(size)
    short = [sum(files[f]) for f in sorted(files) if f >= 0]
    assert all(sum(f) <= 100 and len(f) <= max_events for f in files.values())
    assert all(len(files[f]) == 1 for f in files if f < 0)
    assert sum(map(len, files.values())) == 300
    # Neighbours hold more than one file may, unless events closed the first.
    assert max_events == 7 or all(a + b > 100 - 50 for a, b in zip(short, short[1:]))


def test_lines_beyond_the_limit_stand_alone(spark):
    assert numbered(spark, [10, 500, 10, 500, 10], 100) == [(0, 10), (-1, 500), (0, 10), (-2, 500), (0, 10)]
    assert numbered(spark, [50, 50, 50], 100) == [(0, 50), (1, 50), (2, 50)]


def test_null_days_are_numbered(spark):
    rows = [(None, None, 1, "a"), ("t", None, 2, "b"), ("t", None, 3, "b"), ("t", DAY, None, None)]
    found = log.number_files(spark.createDataFrame(rows, LINES))
    assert found.count() == 4 and {r.file for r in found.where("line IS NOT NULL").collect()} == {0}


def test_rolled_log_keeps_every_event(spark, tmp_path):
    root, rows = str(tmp_path), history(3)
    for part in range(2):
        deliver(spark, root, rows[part::2])
        stream = log.read_change_stream(spark, root, "orders", SCHEMA).withColumn("table", F.lit("orders"))
        log.write_rolled_log(stream, f"{root}/log", f"{root}/checkpoint", None, max_bytes=1000, segment=8).awaitTermination()
    found = log.read_rolled_log(spark, f"{root}/log", SCHEMA, "orders").withColumn("size", F.col("_metadata.file_size"))
    assert sorted(r[0] for r in found.select("source.lsn").collect()) == list(range(80))
    assert found.agg(F.max("size")).first()[0] <= 1000
    assert found.select("batch").distinct().count() == 2


def test_rolled_log_is_listed_by_few_tasks(spark, tmp_path):
    root, tracker = f"{tmp_path}/log", spark.sparkContext.statusTracker()
    for batch in range(2):
        for table in ("orders", "a:b", "payments"):
            for day in ("2026-01-21", "__HIVE_DEFAULT_PARTITION__"):
                for file in range(-1, 34):
                    folder = tmp_path / f"log/batch={batch:09d}/table={table.replace(':', '%3A')}/dt={day}/file={file}"
                    folder.mkdir(parents=True)
                    (folder / "part.txt").write_text('{"op":"c","source":{"lsn":%d}}\n' % (batch * 100 + file))
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        found = {t: log.read_rolled_log(spark, root, SCHEMA, t) for t in ("orders", "a:b", "orderss")}
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("listing")]
        tasks = sum(tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tasks <= 64
    assert found["orderss"].select("*", "_metadata.file_size").count() == 0
    for table in ("orders", "a:b"):
        rows = found[table].select("table", "dt", "batch", "file", "source.lsn").collect()
        assert len(rows) == len(set(rows)) == 2 * 2 * 35 and {r.table for r in rows} == {table}
        assert all(r.lsn == r.batch * 100 + r.file for r in rows) and {str(r.dt) for r in rows} == {"2026-01-21", "None"}
