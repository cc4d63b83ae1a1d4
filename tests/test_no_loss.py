"""Rows that were once lost without a word: old state, late cancels, orphans, empty values."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import SCHEMA, change, deliver, stream
from tidemark.functions import cents
from tidemark.operators import changes, gold, quality, select, silver
from tidemark.plans import layers
from tidemark.schemas import SCHEMAS, get_schema
from tidemark.sources import change_log, csv_files, epochs, tables
from tidemark.streaming import log, state

DAY = dt.datetime(2026, 1, 21)


@pytest.mark.parametrize("cancel_at", [5, 6, 9])
@pytest.mark.parametrize("status, expected", [("unavailable", "canceled"), ("created", "delivered")])
def test_a_late_cancel_counts_for_unknown_statuses(spark, cancel_at, status, expected):
    orders = spark.createDataFrame([("a", "c", status, DAY, None, None, None, DAY)], get_schema("orders"))
    rows = [("a", n, DAY, n == cancel_at) for n in range(1, 10)]
    events = spark.createDataFrame(rows, "order_id string, lsn long, at timestamp_ntz, cancel boolean")
    assert silver.apply_transition(orders, events).first().order_status == expected


def test_a_new_checkpoint_does_not_hide_or_destroy_state(spark, tmp_path):
    root = str(tmp_path)

    def run(checkpoint, **options):
        state.upsert_stream(
            stream(spark, root, 1), f"{root}/state", ["order_id"], f"{root}/{checkpoint}", None, 2, **options
        ).awaitTermination()
        return {(r.order_id, r.lsn) for r in state.read_state(spark, f"{root}/state", ["order_id"]).collect()}

    for n in range(3):
        deliver(spark, root, [change(f"k{n}", n, "c")])
    assert run("one") == {("k0", 0), ("k1", 1), ("k2", 2)}
    deliver(spark, root, [change("k0", 9, "u")])
    with pytest.raises(Exception, match="another checkpoint"):
        run("two")
    assert run("three", take_over=True) == {("k0", 9), ("k1", 1), ("k2", 2)}
    deliver(spark, root, [change("k3", 10, "c")])
    assert run("three") == {("k0", 9), ("k1", 1), ("k2", 2), ("k3", 10)}


def test_appended_rows_survive_a_new_checkpoint(spark, tmp_path):
    root = str(tmp_path)

    def run(checkpoint, **options):
        rows = f"{root}/rows"
        state.append_stream(stream(spark, root, 1), rows, None, f"{root}/{checkpoint}", None, **options).awaitTermination()
        return sorted((r.order_id, r.lsn) for r in state.read_appended(spark, rows).collect())

    # Two rows of one insert share a position.
    deliver(spark, root, [change("a", 1, "c"), change("b", 1, "c")])
    assert run("one") == [("a", 1), ("b", 1)]
    deliver(spark, root, [change("c", 2, "c")])
    with pytest.raises(Exception, match="another checkpoint"):
        run("two")
    assert run("three", take_over=True) == [("a", 1), ("b", 1), ("c", 2)]


def test_csv_keeps_null_and_empty_apart(spark, tmp_path):
    schema = "a string, n int, b string"
    rows = [(None, 1, ""), ("", None, None), (' x"y', 3, "line\nbreak, comma"), ("", 4, "")]
    path = csv_files.write_snapshot(spark.createDataFrame(rows, schema), str(tmp_path), "t")
    for multiline in (True, None):
        read = csv_files.load_csv(spark, path, spark.createDataFrame([], schema).schema, multiline)
        assert sorted(map(tuple, read.collect()), key=str) == sorted(rows, key=str)


def test_external_tables_fail_on_bad_rows(spark, tmp_path):
    folder = tmp_path / "bad" / "snapshot"
    folder.mkdir(parents=True)
    (folder / "f.csv").write_text("a,n\nx,1\ny,oops\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS no_loss")
    schema = spark.createDataFrame([], "a string, n int").schema
    try:
        name = tables.create_snapshot_table(spark, "bad", str(tmp_path), "no_loss", schema)
        with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
            spark.table(name).collect()
    finally:
        spark.sql("DROP DATABASE no_loss CASCADE")


def test_items_without_order_stay(spark):
    items = spark.createDataFrame([("gone", 1, "p", "s", DAY, 1.005, 2.0)], get_schema("order_items"))
    orders, customers = (spark.createDataFrame([], get_schema(t)) for t in ("orders", "customers"))
    row = gold.fact_order_items(items, orders, customers).first()
    assert row.order_id == "gone" and row.customer_id is None and str(row.price) == "1.01"


def test_amounts_are_rounded_as_decimals(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (0.1,), (None,)], "x double")
    assert [r[0] for r in df.select(cents(F.col("x"))).collect()] == [101, -101, 10, None]


def test_events_without_delivery_day_are_kept(spark):
    rows = [("t", "a", 1, "c", None), ("t", "b", 2, "c", None), ("t", "b", 2, "c", dt.date(2026, 1, 2))]
    df = spark.createDataFrame(rows, "table string, key string, lsn long, op string, dt date")
    found = {tuple(r) for r in changes.dedupe_changes(df).collect()}
    assert found == {rows[0], rows[2]}


GOOD = '{"op":"c","ts_ms":1,"after":{"order_id":"%s","order_status":"x","more":1},"source":{"lsn":%d,"table":"orders"},"new":2}'


def lines(root, *texts, folder="dt=2026-01-21", table="orders"):
    path = root / table / "cdc" / folder
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.json").write_text("\n".join(texts) + "\n")


def test_unreadable_events_fail_or_are_kept(spark, tmp_path):
    good = [GOOD % ("a", 1), GOOD % ("b", 2)]
    bad = [GOOD[:-9] % ("c", 3), (GOOD % ("d", 4)).replace(":4,", ':"four",'), '{"source":{"lsn":5}}', "[1]"]
    lines(tmp_path, *good, "null", *bad)
    root = str(tmp_path)
    with pytest.raises(Exception, match="unreadable event"):
        changes.decode_changes(change_log.read_changes(spark, root, "orders", SCHEMA), SCHEMA).collect()
    read = change_log.read_changes(spark, root, "orders", SCHEMA, keep_unreadable=True)
    assert {r.order_id for r in changes.decode_changes(read, SCHEMA).collect()} == {"a", "b"}
    faulty = changes.unreadable_events(read).collect()
    assert sorted(r.unreadable or f"op missing at {r.source.lsn}" for r in faulty) == sorted(
        ["op missing at 5" if "lsn\":5" in t else t for t in bad]
    )
    rule = quality.check_rows(read, "orders", {"readable events": change_log.is_faulty(read)})
    assert rule.first().failed == 4


def test_an_event_without_operation_is_an_error(spark, tmp_path):
    lines(tmp_path, GOOD % ("a", 1), '{"source":{"lsn":5}}')
    with pytest.raises(Exception, match="no operation"):
        changes.decode_changes(change_log.read_changes(spark, str(tmp_path), "orders", SCHEMA), SCHEMA).collect()


def test_a_stream_stops_at_an_unreadable_line_or_keeps_it(spark, tmp_path):
    lines(tmp_path, GOOD % ("a", 1), GOOD[:-9] % ("c", 3))
    root = str(tmp_path)

    def run(name, keep):
        events = log.read_change_stream(spark, root, "orders", SCHEMA, keep_unreadable=keep)
        writer = events.writeStream.format("parquet").option("path", f"{root}/{name}")
        log.start(writer, f"{root}/check-{name}", None).awaitTermination()
        return spark.read.parquet(f"{root}/{name}")

    with pytest.raises(Exception, match="unreadable event"):
        run("strict", False)
    assert changes.unreadable_events(run("kept", True)).count() == 1


def test_late_first_deliveries_are_an_error(spark, tmp_path):
    root = str(tmp_path)
    source = stream(spark, root, 1).withColumn("event_time", F.timestamp_millis("ts_ms"))
    copies = state.dedupe_stream(source, "1 hour", identity=["table", "order_id", "lsn", "op"])

    def run():
        query = log.start(
            copies.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/checkpoint", None
        )
        query.awaitTermination()
        state.fail_if_dropped(spark, query)

    for lsn in (200_000, 200_001):
        deliver(spark, root, [change("a", lsn)])
        run()
    deliver(spark, root, [change("late", 1)])
    # The late event falls into an early micro-batch, of which Spark keeps no report.
    for lsn in range(200_002, 200_006):
        time.sleep(1.1)
        deliver(spark, root, [change("a", lsn)])
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        with pytest.raises(ValueError, match="^1 events came later than the delay"):
            run()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS no_loss_cdc")
    yield "no_loss_cdc"
    spark.sql("DROP DATABASE no_loss_cdc CASCADE")


def test_external_tables_over_epochs_bad_lines_and_no_folder(spark, tmp_path, database):
    lines(tmp_path, GOOD % ("a", 1), folder="epoch=1/dt=2026-01-21")
    lines(tmp_path, GOOD % ("b", 2), folder="epoch=2/dt=2026-01-21")
    name = tables.create_changes_table(spark, "orders", str(tmp_path), database, SCHEMA, ("epoch", "dt"))
    assert [r.after.order_id for r in spark.table(name).where("epoch = 2").collect()] == ["b"]
    absent = tables.create_changes_table(spark, "sellers", str(tmp_path), database, get_schema("sellers"))
    assert spark.table(absent).count() == 0
    lines(tmp_path, "{broken", table="payments")
    broken = tables.create_changes_table(spark, "payments", str(tmp_path), database, SCHEMA)
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        spark.table(broken).collect()


@pytest.mark.parametrize("keep", [False, True])
def test_layers_take_the_newest_epoch_and_count_unreadable_events(spark, tmp_path, keep):
    root = str(tmp_path)
    for name, schema in SCHEMAS.items():
        rows = {"payments": [("o", 1, "boleto", 1, 5.0)], "orders": [("o", "c", "created", DAY, None, None, None, DAY)]}
        csv_files.write_snapshot(spark.createDataFrame(rows.get(name, []), schema), root, name)
    meta = [F.lit(9).cast("bigint").alias("lsn"), F.lit(2).cast("bigint").alias("ts_ms"), F.to_date(F.lit("2026-01-21")).alias("dt")]
    for epoch, value, status in ((1, 5.0, "stale"), (2, 7.0, "approved")):
        payment = spark.createDataFrame([("o", 1, "boleto", 1, value)], get_schema("payments"))
        order = spark.createDataFrame([("o", "c", status, DAY, DAY, None, None, DAY)], get_schema("orders"))
        for name, op, row in (("payments", "c", payment), ("orders", "u", order)):
            flat = row.select("*", F.lit(op).alias("op"), *meta, F.lit(epoch).alias("epoch"))
            change_log.write_changes(change_log.to_envelope(flat, get_schema(name), name, ["order_id"]), root, name)
        epochs.open_epoch(spark, root, epoch, 0)
    if keep:
        lines(tmp_path, "{broken", folder="epoch=2/dt=2026-01-22")
    prefix = f"epochs{int(keep)}_"
    report = layers.run_layers(spark, root, f"{root}/lake", prefix=prefix, keep_unreadable=keep)
    found = {(r.table, r.rule): (r.checked, r.failed) for r in report.collect()}
    assert sorted(r.payment_value for r in spark.table(f"{prefix}silver.payments").collect()) == [5.0, 7.0]
    assert [r.order_status for r in spark.table(f"{prefix}silver.orders").collect()] == ["approved"]
    assert found["orders changes", "readable events"] == (1 + keep, keep)
    assert found["orders changes", "legal transitions"] == (1, 0)
    assert found["orders", "not empty"] == (1, 0) and found["sellers", "not empty"][1] == 1
    assert found["orders", "paid what is owed"] == (1, 1)
    if keep:
        with pytest.raises(Exception, match="unreadable event"):
            layers.run_layers(spark, root, f"{root}/strict", prefix="strict_")


def test_all_tables_at_one_position(spark):
    base = {"k": spark.createDataFrame([("a", 1)], "id string, n int"), "l": spark.createDataFrame([(1,)], "n int")}
    logs = {
        "k": spark.createDataFrame([("a", 2, "u", 5), ("a", 3, "u", 9)], "id string, n int, op string, lsn long"),
        "l": spark.createDataFrame([(2, "c", 5), (3, "c", 9)], "n int, op string, lsn long"),
    }
    found = changes.snapshot_all_as_of({**base, "m": base["l"]}, logs, {"k": ["id"]}, 5)
    assert [r.n for r in found["k"].collect()] == [2]
    assert sorted(r.n for r in found["l"].collect()) == [1, 2] and found["m"].count() == 1


def test_values_that_do_not_fit_are_counted(spark):
    df = spark.createDataFrame([("s1", "1000"), ("s2", "oops"), ("s3", None)], "seller_id string, seller_zip_code_prefix string")
    found = quality.check_rows(df, "sellers", changes.misfit_rules(df, get_schema("sellers"))).collect()
    assert [(r.rule, r.checked, r.failed) for r in found] == [("fits seller_zip_code_prefix", 3, 1)]


def test_keyed_samples_do_not_depend_on_partitions(spark):
    ids = spark.range(2000).selectExpr("CAST(id AS STRING) AS id")
    drawn = [{r.id for r in select.sample_rows(d, 5, 7, "id").collect()} for d in (ids, ids.repartition(5))]
    assert drawn[0] == drawn[1] and 50 < len(drawn[0]) < 150
    assert select.sample_rows(ids, 100, 7, "id").count() == 2000
