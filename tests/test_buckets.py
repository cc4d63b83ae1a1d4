"""State in a bucketed table: no shuffle of the state, writes that follow the batch, broken writes."""

import glob
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes as cdc
from tidemark.streaming import buckets

ROW = "key long, status string, op string, lsn long"


@pytest.fixture
def table(spark, tmp_path):
    database = f"b_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    name, path = f"{database}.state", f"{tmp_path}/state"
    buckets.open_state(spark, name, path, spark.createDataFrame([], ROW).schema, ["key"], slots=32, buckets=8)
    yield name, path
    spark.sql(f"DROP DATABASE {database} CASCADE")


def files(path):
    return {f: os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def first(spark, n=20_000):
    return spark.range(n).select(F.col("id").alias("key"), F.lit("x").alias("status"), F.lit("c").alias("op"), "id").toDF(
        "key", "status", "op", "lsn"
    )


def test_a_merge_shuffles_the_batch_alone(spark, table):
    name, path = table
    assert buckets.merge_into_buckets(first(spark), name) == 32
    batch = spark.range(100).selectExpr("id as key", "'y' as status", "'u' as op", "id + 50000 as lsn")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = cdc.merge_batch(buckets.stored_buckets(spark, name), batch, ["key"])
        text = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The one shuffle stands on the side of the batch, above its range.
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("Range") > text.index("Exchange hashpartitioning") > text.index("FileScan")
    assert "Bucketed: true" in text and "SelectedBucketsCount: 8 out of 8" in text


def test_what_is_written_follows_the_batch(spark, table):
    name, path = table
    buckets.merge_into_buckets(first(spark), name)
    before = files(path)
    batch = spark.createDataFrame([(5, "y", "u", 50_000), (70_000, "z", "c", 50_001), (9, None, "d", 50_002)], ROW)
    written = buckets.merge_into_buckets(batch, name)
    new = {f: size for f, size in files(path).items() if f not in before}
    assert written <= 3 and 0 < sum(new.values()) < sum(before.values()) / 6
    found = {r.key: r.status for r in buckets.read_buckets(spark, name).collect()}
    assert len(found) == 20_000 and found[5] == "y" and found[70_000] == "z" and 9 not in found
    # Older versions of the slots that were written stay until they are dropped.
    assert buckets.drop_outdated(spark, name, keep=1) == written
    assert {r.key: r.status for r in buckets.read_buckets(spark, name).collect()} == found
    # A late older change revives nothing.
    assert buckets.merge_into_buckets(spark.createDataFrame([(9, "old", "u", 3)], ROW), name) == 1
    assert buckets.read_buckets(spark, name).where("key = 9").count() == 0
    assert buckets.merge_into_buckets(batch.limit(0), name) == 0


def test_a_broken_write_is_not_read_and_is_repeated(spark, table, monkeypatch):
    name, path = table
    buckets.merge_into_buckets(first(spark, 100), name)
    batch = spark.createDataFrame([(5, "y", "u", 500)], ROW)
    make = buckets.make_folder

    def broken(spark, folder):
        raise OSError("lost")

    monkeypatch.setattr(buckets, "make_folder", broken)
    with pytest.raises(OSError):
        buckets.merge_into_buckets(batch, name)
    monkeypatch.setattr(buckets, "make_folder", make)
    assert buckets.read_buckets(spark, name).where("key = 5").first().status == "x"
    buckets.merge_into_buckets(batch, name)
    buckets.merge_into_buckets(batch, name)
    assert buckets.read_buckets(spark, name).where("key = 5").first().status == "y"
    assert buckets.read_buckets(spark, name).count() == 100
    # Another session finds it again.
    again = f"{name}_again"
    buckets.open_state(spark, again, path, spark.createDataFrame([], ROW).schema, ["key"], slots=32, buckets=8)
    assert sorted(buckets.read_buckets(spark, again).collect()) == sorted(buckets.read_buckets(spark, name).collect())


def test_batches_in_any_order_give_the_latest_state(spark, table, tmp_path):
    name, _ = table
    rng = random.Random(2)
    rows = [(rng.randint(0, 40), f"s{i}", rng.choice("cuud"), i) for i in range(300)]
    log = spark.createDataFrame(rows, ROW)
    for part in range(4):
        log.where(f"lsn % 4 = {3 - part}").write.mode("append").parquet(f"{tmp_path}/log")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 9).parquet(f"{tmp_path}/log")
    buckets.upsert_buckets(stream, name, f"{tmp_path}/checkpoint", interval=None).awaitTermination()
    expected = cdc.latest_state(log, ["key"])
    assert sorted(buckets.read_buckets(spark, name).collect()) == sorted(expected.collect())
