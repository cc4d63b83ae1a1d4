"""All layers from files, and the shape of the plans behind them."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import TINY
from tidemark.operators import changes as cdc
from tidemark.operators import delivery_model, gold, quality, silver
from tidemark.plans import layers
from tidemark.plans.bindings import Bindings
from tidemark.plans.catalog import QUERIES, full_table
from tidemark.schemas import SCHEMAS, get_schema
from tidemark.sources import change_log, csv_files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Snapshots of all tables, with changes of orders and payments delivered twice."""
    root = str(tmp_path_factory.mktemp("files"))
    b = Bindings(spark, TINY)
    for name in SCHEMAS:
        csv_files.write_snapshot(full_table(b, name), root, name)
    meta = [F.lit(1).cast("bigint").alias("lsn"), F.lit(2).cast("bigint").alias("ts_ms"), F.to_date(F.lit("2026-01-21")).alias("dt")]
    moved = full_table(b, "orders").where("order_status = 'created'").withColumn("order_status", F.lit("approved"))
    for _ in range(2):
        for name, op, rows in (("orders", "u", moved), ("payments", "c", full_table(b, "payments"))):
            events = change_log.to_envelope(rows.select("*", F.lit(op).alias("op"), *meta), get_schema(name), name, ["order_id"])
            change_log.write_changes(events, root, name)
    return root


def test_run_layers(spark, files, tmp_path):
    report = layers.run_layers(spark, files, str(tmp_path), prefix="all_")
    found = {(r.table, r.rule): (r.checked, r.failed) for r in report.collect()}
    orders = spark.table("all_silver.orders")
    assert orders.where("order_status = 'created'").count() == 0
    assert orders.count() == 1500 == orders.select("order_id").distinct().count()
    assert spark.table("all_silver.payments").count() == 2 * 1500
    assert spark.table("all_silver.geolocation").count() == spark.table("all_silver.geolocation").select("geolocation_zip_code_prefix").distinct().count()
    assert found["orders", "unique order_id"] == (1500, 0)
    assert found["products", "product_category_name in product_category_name_translation"][1] > 0
    assert found["orders", "approved at once past approval"][1] > 0
    assert spark.table("all_gold.fact_order_items").count() == spark.table("all_silver.order_items").count()
    assert spark.table("all_gold.dim_products").where("product_category_name = 'promotion'").count() > 0
    assert len(found) == report.count()


def test_every_registered_query_avoids_nested_loops(spark):
    streams = ("o03", "o07", "o09_changes", "o11", "o15", "o16", "o45", "o51", "o52", "o53", "o54", "o55", "o56", "o57_delivery")
    for name, run in QUERIES.items():
        if not name.startswith(streams):
            text = plan(run(spark, TINY))
            assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_latest_state_is_reduced_before_its_only_shuffle(spark):
    text = plan(cdc.latest_state(Bindings(spark, TINY).changes(), ["key"]))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("Exchange hashpartitioning") < text.index("partial_max_by")


def test_small_batch_does_not_shuffle_the_state(spark, tmp_path):
    state = cdc.as_state(spark.range(100_000).select(F.col("id").alias("key"), F.lit("x").alias("status")))
    state.write.parquet(f"{tmp_path}/state")
    stored = spark.read.parquet(f"{tmp_path}/state")
    batch = spark.createDataFrame([(5, "y", "u", 9)], "key long, status string, op string, lsn long")
    batch.write.parquet(f"{tmp_path}/batch")
    stored_batch = spark.read.parquet(f"{tmp_path}/batch")
    merged = cdc.merge_batch(stored, stored_batch, ["key"], small=True)
    assert merged.count() == 100_000
    text = plan(merged)
    assert "BroadcastHashJoin [key" in text and "LeftAnti" in text and "SortMergeJoin" not in text
    # Of the second read only keys are taken.
    assert text.count("ReadSchema: struct<key:bigint>") >= 1
    once = cdc.merge_batch(stored, stored_batch, ["key"])
    assert sorted(once.collect()) == sorted(merged.collect())
    assert plan(once).split("Initial Plan")[0].count("/state]") == 1


def test_item_fact_reads_only_its_columns(spark):
    b = Bindings(spark, TINY)
    text = plan(gold.order_totals(b.order_items()))
    scan = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert scan == "struct<l_orderkey:bigint,l_extendedprice:double,l_tax:double>"


def test_row_rules_take_one_pass(spark):
    b = Bindings(spark, TINY)
    assert plan(quality.check_milestones(b.orders())).count("FileScan") == 1


def test_reconciliation_joins_without_further_shuffle(spark):
    b = Bindings(spark, TINY)
    items = b.order_items()
    payments = items.select("order_id", F.col("price").alias("payment_value"))
    text = plan(gold.reconcile_payments(items, payments))
    assert text.count("Exchange hashpartitioning") == 2


def test_zip_codes_are_pre_aggregated(spark):
    text = plan(silver.geolocation_unique(Bindings(spark, TINY).geolocation()))
    assert "Join" not in text.split("HashAggregate")[0]
    assert text.count("partial_sum") >= 2


def test_delivery_model_learns_a_linear_rule(spark, tmp_path):
    features = spark.range(200).select(
        F.col("id").cast("string").alias("order_id"),
        (F.col("id") % 3 + 1).cast("double").alias("items"),
        (F.col("id") % 17).cast("double").alias("value"),
        (F.col("id") % 5).cast("double").alias("freight"),
        (F.col("id") % 11).cast("double").alias("hours_to_approval"),
        F.when(F.col("id") % 2 == 0, "SP").otherwise("RJ").alias("state"),
    )
    label = 100 + 3 * F.col("value") - 2 * F.col("freight") + F.when(F.col("state") == "SP", 10).otherwise(0)
    known = features.withColumn("delivery_hours", F.when(F.col("order_id") != "7", label))
    delivery_model.save_model(delivery_model.fit_delivery_model(known), f"{tmp_path}/model")
    scored = delivery_model.score(delivery_model.load_model(f"{tmp_path}/model"), known)
    assert scored.count() == 200
    assert scored.select(F.max(F.abs(F.col("predicted_hours") - F.col("delivery_hours")))).first()[0] < 1
    unseen = known.withColumn("state", F.lit("XX"))
    assert delivery_model.score(delivery_model.load_model(f"{tmp_path}/model"), unseen).count() == 200
