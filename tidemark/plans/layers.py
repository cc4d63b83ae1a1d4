"""From snapshot and change files to silver, gold and the quality report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import changes as cdc
from tidemark.operators import gold, quality, silver
from tidemark.sources import change_log, csv_files, epochs, tables

Frames = dict[str, DataFrame]


def read_snapshots(spark: SparkSession, root: str) -> Frames:
    """The nine snapshot folders below ``root`` in their fixed schemas."""
    return {
        name: csv_files.load_csv(spark, csv_files.snapshot_path(root, name), schema)
        for name, schema in schemas.SCHEMAS.items()
    }


def read_events(spark: SparkSession, root: str, staging: str, keep_unreadable: bool = False) -> Frames:
    """Events of the captured tables; a table without a folder has none.

    Once an epoch has been opened below ``root``, only the folders of the
    newest are read: older changes are part of its snapshot already.

    Kept as Parquet below ``staging``: the merges read a log more than once,
    and only some of its columns, while JSON is parsed whole on every read. So
    every line is looked at in full, and one that cannot be read fails the run,
    or with ``keep_unreadable`` is a row of its own.
    """
    epoch = epochs.current_epoch(spark, root)
    folders = ("dt",) if epoch is None else ("epoch", "dt")
    found = {}
    for name in schemas.CDC_TABLES:
        schema = schemas.get_schema(name)
        events = change_log.read_changes_or_empty(spark, root, name, schema, folders, keep_unreadable)
        if epoch is not None:
            events = cdc.after_bookmark(events, epoch).drop("epoch")
        events.write.mode("overwrite").parquet(f"{staging}/{name}")
        found[name] = spark.read.parquet(f"{staging}/{name}")
    return found


def change_logs(events: Mapping[str, DataFrame]) -> Frames:
    """Flat, typed changes from the events of each table."""

    def flat(name: str) -> DataFrame:
        schema = schemas.get_schema(name)
        return cdc.normalize(cdc.decode_changes(events[name], schema), schema)

    return {name: flat(name) for name in events}


def current_tables(snapshots: Mapping[str, DataFrame], logs: Mapping[str, DataFrame]) -> Frames:
    """Every table after its changes: by key where it has one, else by insert."""

    def current(name: str) -> DataFrame:
        if name not in logs:
            return snapshots[name]
        if name in schemas.KEYS:
            return cdc.current_state(snapshots[name], logs[name], schemas.KEYS[name])
        return cdc.append_only_state(snapshots[name], logs[name])

    return {name: current(name) for name in snapshots}


def build_silver(current: Mapping[str, DataFrame]) -> Frames:
    """Current tables with unique zip codes and English category names."""
    return {
        **current,
        "geolocation": silver.geolocation_unique(current["geolocation"]),
        "products": silver.translate_category(
            current["products"], current["product_category_name_translation"]
        ),
    }


def build_gold(tables_: Mapping[str, DataFrame]) -> Frames:
    """Dimensions and facts from silver tables."""
    orders, customers, places = tables_["orders"], tables_["customers"], tables_["geolocation"]
    return {
        "dim_customers": gold.dim_customers(customers, places),
        "dim_products": tables_["products"],
        "dim_sellers": gold.dim_sellers(tables_["sellers"], places),
        "dim_date": gold.dim_date(orders),
        "fact_orders": gold.fact_orders(orders, customers),
        "fact_order_items": gold.fact_order_items(tables_["order_items"], orders, customers),
        "fact_payments": gold.fact_payments(tables_["payments"], orders),
        "fact_reviews": gold.fact_reviews(tables_["order_reviews"], orders),
        "order_durations": gold.order_durations(orders),
        "order_totals": gold.order_totals(tables_["order_items"]),
    }


def check_tables(current: Mapping[str, DataFrame]) -> DataFrame:
    """All rules over the current tables, before categories are translated."""
    rules = []
    for name, df in current.items():
        per_row = {
            **quality.required_rules(schemas.get_schema(name)),
            **quality.length_rules(schemas.LENGTH_LIMITS[name]),
            **(quality.milestone_rules() if name == "orders" else {}),
        }
        rules.append(quality.check_rows(df, name, per_row))
        if name in schemas.KEYS:
            rules.append(quality.check_unique(df, name, schemas.KEYS[name]))
    rules.append(quality.check_foreign_keys(current))
    rules.append(quality.check_item_sequence(current["order_items"]))
    rules.append(quality.check_write_rules(current))
    rules.append(quality.check_payments(gold.reconcile_payments(current["order_items"], current["payments"])))
    return quality.report(*rules)


def check_events(events: Mapping[str, DataFrame]) -> DataFrame:
    """Events that could be read, values that fit their types, legal steps of orders."""
    rules = []
    for name, df in events.items():
        schema = schemas.get_schema(name)
        faulty = {"readable events": change_log.is_faulty(df)}
        rules.append(quality.check_rows(df, f"{name} changes", faulty))
        decoded = cdc.decode_changes(df, schema)
        rules.append(quality.check_rows(decoded, f"{name} changes", cdc.misfit_rules(decoded, schema)))
        if name == "orders":
            once = cdc.normalize(decoded, schema).dropDuplicates(["order_id", "lsn"])
            rules.append(quality.check_transitions(once, f"{name} changes"))
    return quality.report(*rules)


def mix_profiles(current: Mapping[str, DataFrame]) -> DataFrame:
    """Shares of values in the current tables next to the expected ones."""
    reviews = current["order_reviews"]
    profiles = {
        "payment type": quality.mix_profile(current["payments"], "payment_type", schemas.PAYMENT_TYPE_WEIGHTS),
        "items per order": quality.mix_profile(
            quality.items_per_order(current["order_items"]), "items", schemas.ITEMS_PER_ORDER_WEIGHTS
        ),
        "review score": quality.mix_profile(reviews, "review_score", schemas.REVIEW_SCORE_WEIGHTS),
        "reviewed": quality.mix_profile(
            quality.reviewed_orders(current["orders"], reviews), "reviewed", schemas.REVIEWED_WEIGHTS
        ),
        "review with title": quality.mix_profile(
            reviews.select(F.col("review_comment_title").isNotNull().alias("title")), "title", schemas.REVIEW_TITLE_WEIGHTS
        ),
        "review with text": quality.mix_profile(
            reviews.select(F.col("review_comment_message").isNotNull().alias("text")), "text", schemas.REVIEW_TEXT_WEIGHTS
        ),
        "returning buyer": quality.mix_profile(
            quality.returning_buyers(current["customers"]), "returning", schemas.RETURNING_BUYER_WEIGHTS, weight="n"
        ),
    }
    return quality.report(*(p.select(F.lit(name).alias("profile"), "*") for name, p in profiles.items()))


def run_layers(
    spark: SparkSession, root: str, warehouse: str, prefix: str = "", keep_unreadable: bool = False
) -> DataFrame:
    """Rebuild all layers from the files below ``root``; returns the quality report.

    Each layer is stored before the next one reads it. Changes of the newest
    epoch count if epochs are recorded, else all. An unreadable event fails the
    run; with ``keep_unreadable`` it is left out and counted in the report.
    """
    tables.create_layers(spark, warehouse, prefix)
    snapshots = {
        name: tables.materialize(df, "bronze", name, prefix) for name, df in read_snapshots(spark, root).items()
    }
    events = read_events(spark, root, f"{warehouse}/staged", keep_unreadable)
    current = current_tables(snapshots, change_logs(events))
    stored = {
        name: tables.materialize(df, "silver", name, prefix) for name, df in build_silver(current).items()
    }
    for name, df in {**build_gold(stored), "mix_profile": mix_profiles(stored)}.items():
        tables.materialize(df, "gold", name, prefix)
    untranslated = {"products": current["products"], "geolocation": current["geolocation"]}
    valid = [
        quality.validate_table(spark, f"`{prefix}silver`.`{name}`", schemas.get_schema(name)).withColumn(
            "table", F.lit(name)
        )
        for name in stored
    ]
    return quality.report(check_tables({**stored, **untranslated}), check_events(events), *valid)
