"""CSV snapshots, change-log folders, catalog tables."""

import datetime as dt
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.changes import decode_changes
from tidemark.schemas import CDC_TABLES, SCHEMAS, get_schema, required_columns
from tidemark.sources import change_log, csv_files, epochs, tables


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


@pytest.fixture
def prefix(spark, root):
    name = f"t{abs(hash(root)) % 10**9}_"
    tables.create_layers(spark, f"{root}/warehouse", name)
    return name


def test_catalog():
    assert len(SCHEMAS) == 9
    assert get_schema("refunds") is None
    assert required_columns(get_schema("orders")) == ["order_id"]
    assert required_columns(get_schema("payments")) == []
    assert get_schema("orders")["order_approved_at"].dataType.simpleString() == "timestamp_ntz"


def test_load_csv_by_position_with_byte_order_mark_quotes_and_line_breaks(spark, root):
    put(
        f"{root}/s.csv",
        '﻿id,zip,"a city",state\r\ns1,1000,"Say ""hi"",\nthere",PE\r\ns2,, padded ,\r\n',
    )
    got = [tuple(r) for r in csv_files.load_csv(spark, f"{root}/s.csv", get_schema("sellers")).collect()]
    assert got == [("s1", 1000, 'Say "hi",\nthere', "PE"), ("s2", None, " padded ", None)]


@pytest.mark.parametrize("line", ["s1,1000,Recife,PE,surplus", "s1,oops,Recife,PE"])
def test_load_csv_fails_as_a_whole(spark, root, line):
    put(f"{root}/s.csv", f"seller_id,zip,city,state\ns0,1,a,b\n{line}\n")
    with pytest.raises(Exception, match="Malformed records"):
        csv_files.load_csv(spark, f"{root}/s.csv", get_schema("sellers")).collect()


def test_one_file_of_quoted_text_is_read_by_many_tasks(spark, root):
    rng = random.Random(3)
    pieces = ["a", "\n", '""', ",", "b ", "é", "\r\n", "\n\n"]
    for name, end, head in (("a", "\n", "\ufeffid,zip,city,state"), ("b", "\r\n", 'id,"z\nip",city,state')):
        lines = [head]
        for i in range(600):
            city, state = ("".join(rng.choices(pieces, k=rng.randint(0, 30))) for _ in range(2))
            lines.append(f'{name}{i},{i},"{city}","{state}"')
        put(f"{root}/s/{name}.csv", end.join(lines) + end)
    whole = csv_files.load_csv(spark, f"{root}/s", get_schema("sellers"), multiline=True)
    expected = sorted(whole.collect())
    assert len(expected) == 1200 and whole.rdd.getNumPartitions() <= 2
    # Splits end inside quotes, between \r and \n, and many lie in one value or are empty.
    for size in ("128m", "5000", "611", "64"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            split = csv_files.load_csv(spark, f"{root}/s", get_schema("sellers"))
            assert sorted(split.collect()) == expected
            if size == "5000":
                assert csv_files._split_lines(spark, f"{root}/s/a.csv").rdd.getNumPartitions() > 4
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("text", ["", "a,b,c,d", "a,b,c,d\n", "a,b,c,d\n\n", 'a,b,c,"\nd"\n\r\n'])
def test_files_without_records(spark, root, text):
    put(f"{root}/s.csv", text)
    assert csv_files.load_csv(spark, f"{root}/s.csv", get_schema("sellers")).collect() == []


def test_open_quotes_fail(spark, root):
    put(f"{root}/s.csv", 'a,b,c,d\ns1,1,x,y\ns2,2,"x,y\ns3,3,x,y\n')
    with pytest.raises(Exception, match="not closed"):
        csv_files.load_csv(spark, f"{root}/s.csv", get_schema("sellers")).collect()


@pytest.mark.parametrize("row", ['"o\n1",1,card,1,2.5', "o1,1,card,1", "o1,1,card,1,2.5,more"])
def test_rows_of_another_shape_fail_whatever_is_read(spark, root, row):
    put(f"{root}/b.csv", f"a,b,c,d,e\n{row}\n")
    read = csv_files.load_csv(spark, f"{root}/b.csv", get_schema("payments"))
    for asked in (read, read.select("order_id"), read.groupBy().count()):
        with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
            asked.collect()


def test_free_text_decides_how_files_are_read(spark, root):
    assert all(csv_files.may_hold_line_breaks(get_schema(t)) for t in ("order_reviews", "sellers"))
    assert not any(csv_files.may_hold_line_breaks(get_schema(t)) for t in ("orders", "order_items", "payments"))
    assert csv_files.may_hold_line_breaks(spark.createDataFrame([], "n int, note string").schema)


def test_snapshot_round_trip(spark, root):
    schema = get_schema("order_reviews")
    moment = dt.datetime(2026, 1, 2, 3, 4, 5, 678901)
    rows = [
        ("r1", "o1", 5, "a,b", 'line one\r\nline "two"\nthree\\', moment, None),
        ("r2", "o2", None, None, "  blanks  ", None, moment),
    ]
    path = csv_files.write_snapshot(spark.createDataFrame(rows, schema), root, "order_reviews")
    assert path == f"{root}/order_reviews/snapshot"
    assert sorted(tuple(r) for r in csv_files.load_csv(spark, path, schema).collect()) == rows
    csv_files.write_snapshot(spark.createDataFrame(rows[:1], schema), root, "order_reviews")
    assert csv_files.load_csv(spark, path, schema).count() == 1


def test_snapshot_files_are_bounded(spark, root):
    df = spark.range(1000).selectExpr("string(id) seller_id", "1 zip", "'a' city", "'b' state").coalesce(1)
    path = csv_files.write_snapshot(df, root, "sellers", rows_per_file=300)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 4


def test_external_table_keeps_its_first_definition(spark, root, prefix):
    csv_files.write_snapshot(spark.createDataFrame([("7", 1, "a", "b")], get_schema("sellers")), root, "sellers")
    name = tables.create_snapshot_table(spark, "sellers", root, f"{prefix}bronze")
    assert spark.table(name).schema["seller_id"].dataType.simpleString() == "int"
    tables.create_snapshot_table(spark, "sellers", root, f"{prefix}bronze", get_schema("sellers"))
    assert spark.table(name).schema["seller_id"].dataType.simpleString() == "int"


def test_fixed_external_tables_for_every_schema(spark, root, prefix):
    for name, schema in SCHEMAS.items():
        csv_files.write_snapshot(spark.createDataFrame([], schema), root, name)
    names = tables.create_snapshot_tables(spark, root, f"{prefix}bronze")
    assert sorted(r.name for r in tables.list_tables(spark, f"{prefix}bronze").collect()) == sorted(
        f"{t}_snapshot_external" for t in SCHEMAS
    )
    for name, full in names.items():
        assert spark.table(full).schema == StructType(
            [type(f)(f.name, f.dataType) for f in get_schema(name).fields]
        )


SELLER_EVENT = (
    '{"op":"c","ts_ms":2,"before":null,"after":{"seller_id":"s1","seller_zip_code_prefix":1,"rating":5},'
    '"source":{"lsn":9,"table":"sellers","schema":"public"},"transaction":null}\n'
)


def test_read_changes_ignores_unknown_fields_and_null_lines(spark, root):
    put(f"{root}/sellers/cdc/dt=2026-01-21/10_00_00.json", SELLER_EVENT + "null\n")
    put(f"{root}/sellers/cdc/dt=2026-01-22/10_00_00.json", SELLER_EVENT)
    events = change_log.read_changes(spark, root, "sellers", get_schema("sellers"))
    assert events.count() == 3
    decoded = decode_changes(events, get_schema("sellers"))
    assert sorted((r.seller_id, r.lsn, str(r.dt)) for r in decoded.collect()) == [
        ("s1", 9, "2026-01-21"),
        ("s1", 9, "2026-01-22"),
    ]
    inferred = change_log.read_changes(spark, root, "sellers")
    assert "rating" in inferred.select("after.*").columns
    assert inferred.schema["dt"].dataType.simpleString() == "date"


@pytest.mark.parametrize("fixed", [True, False])
def test_changes_table_takes_up_new_days(spark, root, prefix, fixed):
    schema = get_schema("sellers") if fixed else None
    put(f"{root}/sellers/cdc/dt=2026-01-21/a.json", SELLER_EVENT)
    name = tables.create_changes_table(spark, "sellers", root, f"{prefix}bronze", schema)
    assert spark.table(name).count() == 1
    assert spark.table(name).schema["dt"].dataType.simpleString() == "date"
    assert ("rating" in spark.table(name).select("after.*").columns) == (not fixed)
    put(f"{root}/sellers/cdc/dt=2026-01-22/a.json", SELLER_EVENT)
    tables.create_changes_table(spark, "sellers", root, f"{prefix}bronze", schema)
    late = spark.table(name).where("dt = DATE '2026-01-22'")
    assert late.count() == 1 and spark.table(name).count() == 2
    assert "PartitionFilters: [isnotnull(dt" in late._jdf.queryExecution().executedPlan().toString()


def test_day_filter_skips_folders(spark, root):
    put(f"{root}/sellers/cdc/dt=2026-01-21/a.json", SELLER_EVENT)
    put(f"{root}/sellers/cdc/dt=2026-01-22/a.json", SELLER_EVENT)
    late = change_log.read_changes(spark, root, "sellers", get_schema("sellers")).where("dt >= DATE '2026-01-22'")
    assert late.count() == 1
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert [os.path.basename(os.path.dirname(f)) for f in late.inputFiles()] != []


def test_missing_and_empty_folders_are_empty_logs(spark, root):
    schema = get_schema("sellers")
    missing = change_log.read_changes_or_empty(spark, root, "sellers", schema)
    assert missing.count() == 0
    os.makedirs(f"{root}/customers/cdc")
    empty = change_log.read_changes_or_empty(spark, root, "customers", get_schema("customers"))
    assert empty.count() == 0
    with pytest.raises(PySparkException):
        change_log.read_changes(spark, root, "orders", get_schema("orders")).count()


def test_routing_and_selection(spark):
    names = spark.createDataFrame([(n,) for n in SCHEMAS], "name string")
    assert sorted(r.name for r in change_log.cdc_tables(names).collect()) == sorted(CDC_TABLES)
    only = names.where("name IN ('orders', 'products')")
    assert [r.name for r in change_log.cdc_tables(only).collect()] == ["orders"]
    events = spark.createDataFrame(
        [(("public", "orders"),), (("public", "products"),)], "source struct<schema string, table string>"
    )
    assert [r.topic for r in change_log.route_changes(events, "shop").collect()] == ["shop.public.orders"]


def test_epoch_manifest(spark, root):
    epochs.open_epoch(spark, root, 1, 100)
    epochs.open_epoch(spark, root, 2, 250)
    assert epochs.current_epoch(spark, root) == 2
    assert sorted(tuple(r) for r in epochs.epochs(spark, root).collect()) == [(1, 100), (2, 250)]


def test_materialize_and_append(spark, root, prefix):
    df = spark.createDataFrame([("s1", 1, "a", "b")], get_schema("sellers"))
    assert tables.materialize(df, "bronze", "sellers", prefix).count() == 1
    assert tables.list_tables(spark, f"{prefix}silver").count() == 0
    tables.materialize(df, "silver", "sellers", prefix)
    assert tables.materialize(df, "silver", "sellers", prefix).count() == 1
    reordered = df.select("seller_state", "seller_city", "seller_zip_code_prefix", "seller_id")
    tables.append_rows(reordered, f"{prefix}silver.sellers")
    assert [tuple(r) for r in spark.table(f"{prefix}silver.sellers").collect()] == [("s1", 1, "a", "b")] * 2
    with pytest.raises(ValueError):
        tables.materialize(df, "platinum", "sellers", prefix)


def test_join_of_bucketed_tables_needs_no_shuffle(spark, root, prefix):
    df = spark.range(100).select(F.col("id").cast("string").alias("seller_id"), F.lit(1).alias("x"))
    a = tables.materialize(df, "silver", "a", prefix, ["seller_id"], 4)
    b = tables.materialize(df, "silver", "b", prefix, ["seller_id"], 4)
    plan = a.hint("merge").join(b, "seller_id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
