"""Registry: one query per operator, over the given tables in retail shape.

Names carry the operator's number in the survey. Results use types that every
SQL engine returns alike: decimals become doubles and dates ISO strings.
Queries about files, tables and streams write to a new folder of the shared
scratch area and read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import as_timestamp, micros_of
from tidemark.operators import changes as cdc
from tidemark.operators import delivery_model, gold, quality, select, silver
from tidemark.plans import layers
from tidemark.plans.bindings import Bindings
from tidemark.session import scratch_dir
from tidemark.sources import change_log, csv_files, drift, epochs, tables
from tidemark.streaming import buckets, keyed, lateness, log, state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Row layout of the change log bound to the events table.
CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.LongType(), False),
        T.StructField("status", T.StringType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("value", T.DoubleType()),
    ]
)

STREAM_DELAY = "60 days"  # more than the span of the events, which arrive in any order


def query(name: str):
    def register(build: Callable[[Bindings], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return portable(build(Bindings(spark, folder)))

        QUERIES[name] = run
        return build

    return register


def portable(df: DataFrame) -> DataFrame:
    def column(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*(column(f) for f in df.schema.fields))


# --- shared inputs ---------------------------------------------------------


def full_table(b: Bindings, name: str) -> DataFrame:
    """A bound table with every column of its fixed schema."""
    return cdc.normalize(getattr(b, name)(), schemas.get_schema(name))


def middle(b: Bindings) -> Column:
    """Half of the highest log position."""
    return b.changes().agg(F.floor(F.max("lsn") / 2)).scalar()


def accounts(b: Bindings) -> DataFrame:
    """A snapshot for the change log: one row per customer."""
    return b.raw("customer").select(
        F.col("c_custkey").alias("key"), F.lit("created").alias("status"), F.col("c_acctbal").alias("value")
    )


def epoch_of(day: Column) -> Column:
    return F.when(day < F.lit("2024-01-16").cast("date"), 1).otherwise(2)


def events_of(rows: DataFrame, table: str = "orders") -> DataFrame:
    """Flat change rows as wire events."""
    timed = rows.withColumn("ts_ms", F.floor(micros_of("event_time") / 1000))
    return change_log.to_envelope(timed, CHANGE_SCHEMA, table, ["key"])


def write_log(b: Bindings, rows: DataFrame, label: str, table: str = "orders") -> str:
    root = scratch_dir(b.spark, label)
    change_log.write_changes(events_of(rows, table), root, table)
    return root


def flat(events: DataFrame) -> DataFrame:
    return cdc.normalize(cdc.decode_changes(events, CHANGE_SCHEMA), CHANGE_SCHEMA)


def payload(wire: bool) -> list[Column]:
    """Sums over every value of change events, in wire form or flat."""
    image = "after." if wire else ""
    key = F.coalesce("after.key", "before.key") if wire else F.col("key")
    micros = F.col("after.event_time").cast("bigint") if wire else micros_of("event_time")
    return [
        F.sum(key).alias("sum_key"),
        F.sum(F.length(f"{image}status")).alias("status_chars"),
        F.sum(micros % 1_000_000_000).alias("sum_micros"),
        F.sum(F.floor(F.col(f"{image}value") * 100).cast("bigint")).alias("sum_cents"),
    ]


def share_of_files(b: Bindings, root: str, table: str = "orders", batches: int = 3) -> int:
    """Files per micro-batch, so that a log of any length takes a few batches."""
    files = change_log.read_changes(b.spark, root, table, CHANGE_SCHEMA).inputFiles()
    return -(-len(files) // batches)


def run_to_parquet(stream: DataFrame, root: str, start=log.start) -> None:
    """Process what is there, resuming from the checkpoint below ``root``."""
    writer = stream.writeStream.format("parquet").option("path", f"{root}/out")
    finished = start(writer, f"{root}/checkpoint", interval=None)
    finished.awaitTermination()
    state.fail_if_dropped(stream.sparkSession, finished)


def database_of_tables(b: Bindings, label: str) -> tuple[str, DataFrame]:
    """All bound tables as silver tables of a new database, and their row counts."""
    root = scratch_dir(b.spark, label)
    prefix = f"{label}_{root[-12:]}_"
    tables.create_layers(b.spark, root, prefix)
    for name in schemas.SCHEMAS:
        tables.materialize(full_table(b, name), "silver", name, prefix)
    database = f"{prefix}silver"
    counts = quality.report(
        *(
            b.spark.table(f"`{database}`.`{name}`").agg(F.count("*").alias("rows")).withColumn("name", F.lit(name))
            for name in schemas.SCHEMAS
        )
    )
    return database, counts


# --- scans, sources, sinks -------------------------------------------------


@query("o01_load_csv")
def load_csv(b):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_tax"]
    root = scratch_dir(b.spark, "load-csv")
    path = csv_files.write_snapshot(b.raw("lineitem").select(*columns), root, "order_items")
    return csv_files.load_csv(b.spark, path, schemas.get_schema("order_items"))


@query("o02_schema_catalog")
def schema_catalog(b):
    return full_table(b, "products")


@query("o03_list_tables")
def list_tables(b):
    database, counts = database_of_tables(b, "list_tables")
    return tables.list_tables(b.spark, database).join(counts, "name")


@query("o04_snapshot_as_of")
def snapshot_as_of(b):
    return cdc.snapshot_as_of(accounts(b), b.changes(), ["key"], middle(b))


@query("o05_write_snapshot")
def write_snapshot(b):
    root = scratch_dir(b.spark, "write-snapshot")
    path = csv_files.write_snapshot(full_table(b, "orders"), root, "orders")
    return csv_files.load_csv(b.spark, path, schemas.get_schema("orders"))


@query("o06_snapshot_table_inferred")
def snapshot_table_inferred(b):
    root = scratch_dir(b.spark, "inferred")
    prefix = f"inferred_{root[-12:]}_"
    tables.create_layers(b.spark, root, prefix)
    csv_files.write_snapshot(b.sellers(), root, "sellers")
    return b.spark.table(tables.create_snapshot_table(b.spark, "sellers", root, f"{prefix}bronze"))


@query("o07_snapshot_tables")
def snapshot_tables(b):
    root = scratch_dir(b.spark, "snapshots")
    prefix = f"snapshots_{root[-12:]}_"
    tables.create_layers(b.spark, root, prefix)
    for name in schemas.SCHEMAS:
        csv_files.write_snapshot(full_table(b, name), root, name)
    names = tables.create_snapshot_tables(b.spark, root, f"{prefix}bronze")
    return quality.report(
        *(
            b.spark.table(full).agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
            for name, full in names.items()
        )
    )


@query("o08_quoted_csv")
def quoted_csv(b):
    reviews = b.raw("documents").select(
        F.col("doc_id").cast("string").alias("review_id"), F.col("text").alias("review_comment_message")
    )
    schema = schemas.get_schema("order_reviews")
    path = csv_files.write_snapshot(cdc.normalize(reviews, schema), scratch_dir(b.spark, "quoted"), "order_reviews")
    return csv_files.load_csv(b.spark, path, schema).select("review_id", "review_comment_message")


@query("o09_read_changes")
def read_changes(b):
    events = events_of(b.changes()).withColumn("unknown_field", F.lit("ignored"))
    root = scratch_dir(b.spark, "changes")
    change_log.write_changes(events, root, "orders")
    return flat(change_log.read_changes(b.spark, root, "orders", CHANGE_SCHEMA)).select(
        "lsn", "key", "op", "status", "event_time", "value", "dt"
    )


@query("o09_changes_table")
def changes_table(b):
    root = write_log(b, b.changes(), "cdc-table")
    prefix = f"cdc_table_{root[-12:]}_"
    tables.create_layers(b.spark, root, prefix)
    name = tables.create_changes_table(b.spark, "orders", root, f"{prefix}bronze", CHANGE_SCHEMA)
    return flat(b.spark.table(name)).select("lsn", "key", "op", "status", "event_time", "value", "dt")


def drifting(b: Bindings) -> str:
    """A log whose fields change with the days: value gets fractions, status is added, key becomes text, value goes."""
    rows = b.changes().withColumn("cents", F.col("lsn") % 100)
    first, second, third = (F.lit(d).cast("date") for d in ("2024-01-11", "2024-01-21", "2024-01-26"))
    shapes = [
        (F.col("dt") < first, ["key", F.col("cents").alias("value")]),
        (F.col("dt").between(first, F.date_sub(second, 1)), ["key", (F.col("cents") + 0.5).alias("value"), "status"]),
        (F.col("dt").between(second, F.date_sub(third, 1)), [F.concat(F.lit("k"), "key").alias("key"), (F.col("cents") + 0.5).alias("value"), "status"]),
        (F.col("dt") >= third, [F.concat(F.lit("k"), "key").alias("key"), "status"]),
    ]
    root = scratch_dir(b.spark, "drift")
    for days, fields in shapes:
        event = F.struct("op", F.struct("lsn").alias("source"), F.struct(*fields).alias("after"))
        part = rows.where(days).select("dt", F.to_json(event).alias("value"))
        part.write.mode("append").partitionBy("dt").text(change_log.change_log_path(root, "orders"))
    return root


@query("o09_schema_drift")
def schema_drift(b):
    types = drift.field_types(drift.variant_log(b.spark, drifting(b), "orders"))
    return drift.schema_drift(types)


@query("o09_drifted_changes")
def drifted_changes(b):
    return drift.read_drifted_changes(b.spark, drifting(b), "orders")


@query("o10_partition_discovery")
def partition_discovery(b):
    root = write_log(b, b.changes(), "partitions")
    return (
        change_log.read_changes(b.spark, root, "orders", CHANGE_SCHEMA)
        .groupBy("dt")
        .agg(F.count("*").alias("events"), F.sum("source.lsn").alias("sum_lsn"), *payload(wire=True))
    )


def routed(b: Bindings) -> DataFrame:
    """Events of several tables; geolocation is not among the captured ones."""
    owners = {"created": "customers", "approved": "geolocation", "processing": "order_items", "shipped": "orders"}
    events = events_of(b.changes())
    # The table name travels inside the source block.
    table = F.lit("payments")
    for status, owner in owners.items():
        table = F.when(F.col("after.status") == status, owner).otherwise(table)
    return events.withColumn("source", F.col("source").withField("table", table))


@query("o10_epoch_partitions")
def epoch_partitions(b):
    root = write_log(b, b.changes().withColumn("epoch", epoch_of(F.col("dt"))), "epoch-table")
    prefix = f"epoch_table_{root[-12:]}_"
    tables.create_layers(b.spark, root, prefix)
    name = tables.create_changes_table(b.spark, "orders", root, f"{prefix}bronze", CHANGE_SCHEMA, ("epoch", "dt"))
    return flat(b.spark.table(name)).select("epoch", "dt", "lsn", "key", "op", "status")


@query("o11_change_log_sink")
def change_log_sink(b):
    root = scratch_dir(b.spark, "log-sink")
    change_log.write_changes(routed(b), root, "all")
    stream = log.read_change_stream(b.spark, root, "all", CHANGE_SCHEMA, share_of_files(b, root, "all"))
    log.write_change_log(
        change_log.route_changes(stream, "shop").drop("topic"),
        f"{root}/log",
        f"{root}/checkpoint",
        interval=None,
        events_per_file=1_000_000,  # the whole log at once, not five minutes of it
    ).awaitTermination()
    return quality.report(
        *(
            log.read_change_log(b.spark, f"{root}/log", CHANGE_SCHEMA, table)
            .groupBy("table", "dt")
            .agg(F.count("*").alias("events"), F.sum("source.lsn").alias("sum_lsn"), *payload(wire=True))
            for table in schemas.CDC_TABLES
        )
    )


@query("o11_rolled_log")
def rolled_log(b):
    """Files of the byte-bounded sink; a tenth of the usual limits, so that days of a small log roll too."""
    root = scratch_dir(b.spark, "rolled-log")
    change_log.write_changes(routed(b), root, "all")
    stream = log.read_change_stream(b.spark, root, "all", CHANGE_SCHEMA)
    most = log.ROLL_BYTES // 10
    log.write_rolled_log(
        change_log.route_changes(stream, "shop"),
        f"{root}/log",
        f"{root}/checkpoint",
        interval=None,
        max_bytes=most,
        max_events=log.ROLL_EVENTS // 10,
        segment=1 << 12,
    ).awaitTermination()
    files = quality.report(
        *(
            log.read_rolled_log(b.spark, f"{root}/log", CHANGE_SCHEMA, table).withColumn("size", F.col("_metadata.file_size"))
            for table in schemas.CDC_TABLES
        )
    )
    return files.groupBy("table", "dt", "file").agg(
        F.count("*").alias("events"),
        F.min("source.lsn").alias("first_lsn"),
        F.max("source.lsn").alias("last_lsn"),
        (F.max("size") <= most).alias("within_bytes"),
        *payload(wire=True),
    )


@query("o12_route_changes")
def route_changes(b):
    return change_log.route_changes(routed(b), "shop").select("topic", F.col("source.lsn").alias("lsn"), "op")


@query("o13_snapshot_diff")
def snapshot_diff(b):
    old = cdc.snapshot_as_of(accounts(b), b.changes(), ["key"], middle(b))
    new = cdc.current_state(accounts(b), b.changes(), ["key"])
    return cdc.snapshot_diff(old, new, ["key"]).select(
        "key",
        "op",
        *(F.col(f"{image}.{c}").alias(f"{image}_{c}") for image in ("before", "after") for c in ("status", "value")),
    )


@query("o13_keyless_diff")
def keyless_diff(b):
    """Item lines between two states that each lack some orders; most rows are repeated on both sides."""
    lines = b.order_items().select("order_id", "seller_id", "order_item_id", F.col("price") > 20_000)
    lines = lines.toDF("order_id", "seller_id", "order_item_id", "dear")
    short = F.col("order_id").cast("bigint")
    columns = ["seller_id", "order_item_id", "dear"]
    found = cdc.multiset_diff(lines.where(short % 7 != 0).select(*columns), lines.where(short % 5 != 0).select(*columns))
    return found.select("op", *(F.coalesce(f"before.{c}", f"after.{c}").alias(c) for c in columns))


@query("o14_missing_changes")
def missing_changes(b):
    root, schema = scratch_dir(b.spark, "missing"), schemas.get_schema("sellers")
    events = change_log.read_changes_or_empty(b.spark, root, "sellers", schema)
    changes = cdc.normalize(cdc.decode_changes(events, schema), schema)
    return cdc.current_state(b.sellers(), changes, ["seller_id"])


@query("o15_cdc_tables")
def cdc_tables(b):
    database, counts = database_of_tables(b, "cdc_tables")
    return change_log.cdc_tables(tables.list_tables(b.spark, database)).join(counts, "name")


@query("o16_materialize")
def materialize(b):
    root = scratch_dir(b.spark, "layers")
    prefix = f"layers_{root[-12:]}_"
    tables.create_layers(b.spark, root, prefix)
    customers = tables.materialize(b.customers(), "bronze", "customers", prefix)
    places = tables.materialize(silver.geolocation_unique(b.geolocation()), "silver", "geolocation", prefix)
    customers = tables.materialize(customers, "silver", "customers", prefix, bucket_keys=["customer_id"])
    return tables.materialize(gold.dim_customers(customers, places), "gold", "dim_customers", prefix)


@query("o17_append_rows")
def append_rows(b):
    root = scratch_dir(b.spark, "append")
    prefix = f"append_{root[-12:]}_"
    tables.create_layers(b.spark, root, prefix)
    orders = full_table(b, "orders")
    is_open = F.col("order_status") == "created"
    tables.materialize(orders.where(~is_open), "silver", "orders", prefix)
    tables.append_rows(orders.where(is_open), f"`{prefix}silver`.`orders`")
    return b.spark.table(f"`{prefix}silver`.`orders`")


# --- change-log processing and silver layer --------------------------------


@query("o18_decode_changes")
def decode_changes(b):
    events = events_of(b.changes())
    empty = events.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema.fields))
    decoded = cdc.decode_changes(events.unionAll(empty), CHANGE_SCHEMA)
    return decoded.select("lsn", "key", "op", "status", "event_time", "value", "ts_ms", "table", "dt")


@query("o18_unreadable_events")
def unreadable_events(b):
    # Every seventh line is cut off, every eleventh other one has a text for its position.
    events = events_of(b.changes())
    events = events.withColumn("line", F.to_json(F.struct(*(c for c in events.columns if c != "dt"))))
    position = F.col("source.lsn")
    line = (
        F.when(position % 7 == 0, F.expr("left(line, length(line) - 2)"))
        .when(position % 11 == 0, F.regexp_replace("line", r'"lsn":(\d+)', '"lsn":"no $1"'))
        .otherwise(F.col("line"))
    )
    root = scratch_dir(b.spark, "unreadable")
    path = change_log.change_log_path(root, "orders")
    events.select(line.alias("value"), "dt").write.partitionBy("dt").text(path)
    read = change_log.read_changes(b.spark, root, "orders", CHANGE_SCHEMA, keep_unreadable=True)
    good = flat(read).select("lsn", "key", "op", "status", F.lit(True).alias("readable"), "dt")
    bad = cdc.unreadable_events(read).select(
        F.regexp_extract("unreadable", r'"lsn":(?:"no )?(\d+)', 1).cast("bigint").alias("lsn"),
        F.lit(None).cast("bigint").alias("key"),
        F.lit(None).cast("string").alias("op"),
        F.lit(None).cast("string").alias("status"),
        F.lit(False).alias("readable"),
        "dt",
    )
    return good.unionAll(bad)


@query("o19_normalize")
def normalize(b):
    orders = b.orders()
    wire = orders.select(
        F.col("order_id").cast("bigint").alias("ORDER_ID"),
        "customer_id",
        "order_status",
        micros_of("order_purchase_timestamp").alias("order_purchase_timestamp"),
        micros_of("order_approved_at").cast("string").alias("order_approved_at"),
        F.col("order_delivered_carrier_date").cast("string").alias("order_delivered_carrier_date"),
        "order_estimated_delivery_date",
    )
    return cdc.normalize(wire, schemas.get_schema("orders"))


def redelivered(b: Bindings) -> DataFrame:
    """The log with every event delivered twice, the copy a day later."""
    changes = b.changes().withColumn("table", F.lit("orders"))
    return changes.unionAll(changes.withColumn("dt", F.date_add("dt", 1)))


@query("o20_dedupe_changes")
def dedupe_changes(b):
    return cdc.dedupe_changes(redelivered(b))


@query("o21_unify")
def unify(b):
    return cdc.unify(accounts(b), b.changes()).select("key", "status", "value", "op", "lsn", "event_time")


@query("o22_latest_state")
def latest_state(b):
    return cdc.latest_state(b.changes(), ["key"]).select("key", "lsn", "op", "status", "event_time", "value")


@query("o22_current_state")
def current_state(b):
    return cdc.current_state(accounts(b), b.changes(), ["key"])


@query("o23_after_bookmark")
def after_bookmark(b):
    rows = b.changes().withColumn("epoch", epoch_of(F.col("dt")))
    root = write_log(b, rows, "epochs")
    epochs.open_epoch(b.spark, root, 1, 0)
    epochs.open_epoch(b.spark, root, 2, 0)
    events = change_log.read_changes(b.spark, root, "orders", CHANGE_SCHEMA, folders=("epoch", "dt"))
    current = cdc.after_bookmark(flat(events), epochs.current_epoch(b.spark, root))
    return cdc.current_state(accounts(b), current, ["key"])


def payment_changes(b: Bindings) -> DataFrame:
    """Every event as a payment in a whole amount, so that equal rows occur."""
    return b.changes().select(
        F.col("key").cast("string").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.lit("credit_card").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.floor("value").cast("double").alias("payment_value"),
        F.lit("c").alias("op"),
        "lsn",
        "event_time",
        "dt",
    )


@query("o23_epoch_tables")
def epoch_tables(b):
    """Two epochs of a keyed and of a keyless table, merged as the layers do."""
    root = scratch_dir(b.spark, "epoch-tables")
    keyed = b.changes().selectExpr("CAST(key AS STRING) AS order_id", "status AS order_status", "op", "lsn", "event_time", "dt")
    for name, rows in (("orders", keyed), ("payments", payment_changes(b))):
        schema = schemas.get_schema(name)
        rows = rows.withColumns({"ts_ms": F.floor(micros_of("event_time") / 1000), "epoch": epoch_of(F.col("dt"))})
        events = change_log.to_envelope(cdc.normalize(rows.drop("event_time"), schema), schema, name, ["order_id"])
        change_log.write_changes(events, root, name)
    for epoch in (1, 2):
        epochs.open_epoch(b.spark, root, epoch, 0)
    logs = layers.change_logs(layers.read_events(b.spark, root, f"{root}/staged"))
    found = layers.current_tables({name: full_table(b, name) for name in ("orders", "payments")}, logs)
    orders = found["orders"].select(
        F.lit("orders").alias("table"), "order_id", F.col("order_status").alias("status"), F.lit(None).cast("double").alias("value")
    )
    return orders.unionAll(found["payments"].select(F.lit("payments"), "order_id", "payment_type", "payment_value"))


@query("o24_append_only_state")
def append_only_state(b):
    inserts = payment_changes(b)
    return cdc.append_only_state(b.payments(), inserts.unionAll(inserts))


@query("o24_append_stream")
def append_stream(b):
    """Every event as an insert, delivered twice, collected under two checkpoints."""
    root = write_log(b, redelivered(b).drop("table").withColumn("op", F.lit("c")), "append")
    for checkpoint in ("first", "second"):
        stream = open_stream(b, root, share_of_files(b, root)).drop("dt", "ts_ms")
        state.append_stream(
            stream, f"{root}/state", None, f"{root}/{checkpoint}", interval=None, take_over=checkpoint == "second"
        ).awaitTermination()
    return state.read_appended(b.spark, f"{root}/state").select("lsn", "key", "op", "status", "event_time", "value")


@query("o25_geolocation_unique")
def geolocation_unique(b):
    return silver.geolocation_unique(b.geolocation())


@query("o26_translate_category")
def translate_category(b):
    return silver.translate_category(b.products(), b.product_category_name_translation())


@query("o27_merge_batch")
def merge_batch(b):
    root = scratch_dir(b.spark, "merge")
    changes = b.changes().drop("dt")
    cdc.latest_image(changes.where(F.col("lsn") <= middle(b)), ["key"]).write.parquet(f"{root}/1")
    # The second batch repeats half of the first.
    batch = changes.where(F.col("lsn") * 2 > middle(b))
    merged = cdc.merge_batch(b.spark.read.parquet(f"{root}/1"), batch, ["key"])
    merged.write.parquet(f"{root}/2")
    return cdc.live(b.spark.read.parquet(f"{root}/2")).select("key", "lsn", "op", "status", "event_time", "value")


@query("o27_merge_buckets")
def merge_buckets(b):
    """The batches of o27_merge_batch into a bucketed table, and a few more."""
    root, rows = scratch_dir(b.spark, "buckets"), b.changes().drop("dt")
    database = f"buckets_{root.rsplit('-', 1)[1]}"
    b.spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    buckets.open_state(b.spark, f"{database}.state", f"{root}/state", rows.schema, ["key"], slots=16)
    for part in (F.col("lsn") <= middle(b), F.col("lsn") * 2 > middle(b), F.col("key") < 20, F.col("lsn") < 0):
        buckets.merge_into_buckets(rows.where(part), f"{database}.state")
    buckets.drop_outdated(b.spark, f"{database}.state")
    found = buckets.read_buckets(b.spark, f"{database}.state")
    return found.select("key", "lsn", "op", "status", "event_time", "value")


@query("o28_apply_transition")
def apply_transition(b):
    events = b.changes().select(
        F.col("key").cast("string").alias("order_id"),
        "lsn",
        F.col("event_time").alias("at"),
        (F.col("op") == "d").alias("cancel"),
    )
    return silver.apply_transition(b.orders(), events)


# --- projections, filters, samples, limits ---------------------------------


@query("o29_select_all")
def select_all(b):
    return select.project(b.customers())


@query("o30_select_columns")
def select_columns(b):
    return select.project(b.geolocation(), "geolocation_zip_code_prefix", "geolocation_city", "geolocation_state")


@query("o31_lookup")
def lookup(b):
    return select.lookup(b.order_items(), "product_id", "7").select("order_id", "order_item_id", "price")


@query("o32_open_orders")
def open_orders(b):
    return select.open_orders(b.orders()).select("order_id", "order_status")


@query("o33_sample_rows")
def sample_rows(b):
    return select.sample_rows(b.customers(), 5, seed=7, key="customer_id")


@query("o33_sample_blocks")
def sample_blocks(b):
    """Whole delivery days of a log, two in five."""
    root = write_log(b, b.changes(), "blocks")
    events = b.spark.read.schema(change_log.log_schema(CHANGE_SCHEMA)).json(change_log.change_log_path(root, "orders"))
    drawn = select.sample_files(events, 40, seed=7, block="dt=[^/]+")
    return flat(drawn).select("lsn", "key", "op", "status", "event_time", "value", "dt")


@query("o34_random_top")
def random_top(b):
    return select.random_top(select.open_orders(b.orders()), 100, seed=7, key="order_id").select(
        "order_id", "order_status"
    )


@query("o35_first_rows")
def first_rows(b):
    order = [F.desc("price"), "order_id", "order_item_id", "product_id", "seller_id", "freight_value"]
    return select.first_rows(b.order_items().drop("shipping_limit_date"), 100, *order)


@query("o36_price_or_default")
def price_or_default(b):
    return select.price_or_default(b.order_items(), b.products(), 100.0)


@query("o36_price_as_of")
def price_as_of(b):
    """Every item with the price of an earlier item of its product."""
    items = b.order_items()
    requests = items.select("order_id", "order_item_id", "product_id", F.col("shipping_limit_date").alias("at"))
    return select.price_as_of(requests, items, 100.0)


@query("o36_place_or_default")
def place_or_default(b):
    """Zip codes moved on by ten, so that the highest are in no list of places."""
    zip_code = "customer_zip_code_prefix"
    moved = b.customers().select("customer_id", (F.col(zip_code) + 10).cast("int").alias(zip_code))
    return silver.place_or_default(moved, silver.geolocation_unique(b.geolocation()), zip_code)


# --- star schema -----------------------------------------------------------


@query("o37_dim_customers")
def dim_customers(b):
    return gold.dim_customers(b.customers(), silver.geolocation_unique(b.geolocation()))


@query("o37_dim_products")
def dim_products(b):
    return gold.dim_products(full_table(b, "products"), b.product_category_name_translation())


@query("o37_dim_sellers")
def dim_sellers(b):
    return gold.dim_sellers(b.sellers(), silver.geolocation_unique(b.geolocation()))


@query("o38_dim_date")
def dim_date(b):
    return gold.dim_date(b.orders())


@query("o39_fact_orders")
def fact_orders(b):
    return gold.fact_orders(b.orders(), b.customers())


@query("o39_fact_order_items")
def fact_order_items(b):
    return gold.fact_order_items(b.order_items(), b.orders(), b.customers())


@query("o39_fact_payments")
def fact_payments(b):
    return gold.fact_payments(b.payments(), b.orders())


@query("o39_fact_reviews")
def fact_reviews(b):
    return gold.fact_reviews(full_table(b, "order_reviews"), b.orders())


@query("o40_order_totals")
def order_totals(b):
    return gold.order_totals(b.order_items())


@query("o40_reconcile_payments")
def reconcile_payments(b):
    return gold.reconcile_payments(b.order_items(), b.payments())


# --- data quality ----------------------------------------------------------


@query("o41_check_unique")
def check_unique(b):
    keyed = (quality.check_unique(getattr(b, t)(), t, keys) for t, keys in schemas.KEYS.items())
    return quality.report(*keyed, quality.check_unique(b.order_items(), "order_items", ["order_id", "order_item_id"]))


@query("o42_check_required")
def check_required(b):
    category = {"required product_category_name": F.col("product_category_name").isNull()}
    return quality.report(
        *(quality.check_required(getattr(b, t)(), t, schemas.get_schema(t)) for t in schemas.KEYS),
        quality.check_rows(b.products(), "products", category),
    )


@query("o43_check_fk")
def check_fk(b):
    return quality.check_foreign_keys({name: getattr(b, name)() for name in schemas.SCHEMAS})


@query("o44_check_length")
def check_length(b):
    limits = {**schemas.LENGTH_LIMITS, "order_reviews": {"review_id": 64, "order_id": 64, "review_comment_message": 300}}
    return quality.report(*(quality.check_length(getattr(b, t)(), t, limit) for t, limit in limits.items()))


@query("o45_validate_table")
def validate_table(b):
    database, _ = database_of_tables(b, "validate")
    checks = [
        quality.validate_table(b.spark, f"{database}.{name}", schemas.get_schema(name)).withColumn("table", F.lit(name))
        for name in schemas.SCHEMAS
    ]
    wrong = quality.validate_table(b.spark, f"{database}.orders", schemas.get_schema("customers"))
    absent = quality.validate_table(b.spark, f"{database}.refunds", schemas.get_schema("payments"))
    return quality.report(
        *checks, wrong.withColumn("table", F.lit("wrong schema")), absent.withColumn("table", F.lit("absent"))
    )


@query("o46_illegal_transitions")
def illegal_transitions(b):
    # Positions here number the events, so a segment is far shorter than in a real log.
    return quality.illegal_transitions(b.changes(), "key", "status", segment=1 << 12)


@query("o47_check_milestones")
def check_milestones(b):
    return quality.check_milestones(b.orders())


@query("o47_check_write_rules")
def check_write_rules(b):
    names = ("orders", "order_items", "payments", "order_reviews", "customers")
    return quality.check_write_rules({name: full_table(b, name) for name in names})


@query("o48_check_item_sequence")
def check_item_sequence(b):
    return quality.check_item_sequence(b.order_items())


@query("o49_mix_profile")
def mix_profile(b):
    return layers.mix_profiles({name: getattr(b, name)() for name in ("orders", "payments", "order_items", "order_reviews", "customers")})


@query("o49_cancel_mix")
def cancel_mix(b):
    steps = quality.cancelled_steps(b.changes(), "key", "status", segment=1 << 12)
    return quality.mix_profile(steps, "cancelled", schemas.CANCEL_WEIGHTS)


@query("o50_order_durations")
def order_durations(b):
    return gold.order_durations(b.orders())


# --- streaming -------------------------------------------------------------


def open_stream(b: Bindings, root: str, max_files: int | None = None) -> DataFrame:
    return flat(log.read_change_stream(b.spark, root, "orders", CHANGE_SCHEMA, max_files))


@query("o51_change_stream")
def change_stream(b):
    root = write_log(b, b.changes(), "stream")
    run_to_parquet(open_stream(b, root), root)
    return b.spark.read.parquet(f"{root}/out").select("lsn", "key", "op", "status", "event_time", "value", "dt")


@query("o52_resume")
def resume(b):
    early = F.col("lsn") <= middle(b)
    root = write_log(b, b.changes().where(early), "resume")
    run_to_parquet(open_stream(b, root), root)
    change_log.write_changes(events_of(b.changes().where(~early)), root, "orders")
    run_to_parquet(open_stream(b, root), root)
    return b.spark.read.parquet(f"{root}/out").select("lsn", "key", "op", "dt")


@query("o53_micro_batches")
def micro_batches(b):
    root = write_log(b, b.changes(), "batches")
    run_to_parquet(open_stream(b, root, share_of_files(b, root)), root)
    return b.spark.read.parquet(f"{root}/out").groupBy("op").agg(
        F.count("*").alias("events"), F.sum("lsn").alias("sum_lsn"), *payload(wire=False)
    )


@query("o54_dedupe_stream")
def dedupe_stream(b):
    root = write_log(b, redelivered(b), "dedupe")
    stream = open_stream(b, root, share_of_files(b, root, batches=2))
    # A delete carries only its key, so the event time comes from the envelope.
    timed = stream.withColumn("event_time", F.timestamp_millis("ts_ms"))
    run_to_parquet(state.dedupe_stream(timed, STREAM_DELAY), root)
    return b.spark.read.parquet(f"{root}/out").select("lsn", "key", "op", "status", "value")


def upserted(b: Bindings, root: str, checkpoint: str = "checkpoint", take_over: bool = False) -> DataFrame:
    state.upsert_stream(
        open_stream(b, root, share_of_files(b, root)),
        f"{root}/state",
        ["key"],
        f"{root}/{checkpoint}",
        interval=None,
        compact_every=2,
        take_over=take_over,
    ).awaitTermination()
    return state.read_state(b.spark, f"{root}/state", ["key"]).select("key", "lsn", "op", "status", "event_time", "value")


@query("o55_upsert_stream")
def upsert_stream(b):
    return upserted(b, write_log(b, redelivered(b).drop("table"), "upsert"))


@query("o55_upsert_restart")
def upsert_restart(b):
    """One stored state under two checkpoints, the second of which reads the whole log again."""
    early = F.col("lsn") <= middle(b)
    root = write_log(b, b.changes().where(early), "restart")
    upserted(b, root, "first")
    change_log.write_changes(events_of(b.changes().where(~early)), root, "orders")
    return upserted(b, root, "second", take_over=True)


@query("o55_keyed_stream")
def keyed_stream(b):
    """Every event delivered twice, the second half after a restart; state in the engine."""
    early = F.col("lsn") <= middle(b)
    copies = redelivered(b).drop("table")
    root = write_log(b, copies.where(early), "keyed")
    for rest in (None, copies.where(~early)):
        if rest is not None:
            change_log.write_changes(events_of(rest), root, "orders")
        stream = open_stream(b, root, share_of_files(b, root))
        run_to_parquet(keyed.newest_images(stream, "key"), root, keyed.start_keyed)
    newest = cdc.latest_state(b.spark.read.parquet(f"{root}/out"), ["key"])
    return newest.select("key", "lsn", "op", "status", "event_time", "value")


@query("o46_illegal_steps_stream")
def illegal_steps_stream(b):
    """Illegal steps as they happen; every seventh change comes after a restart, behind later ones of its key."""
    late = F.col("lsn") % 7 == 0
    root = write_log(b, b.changes().where(~late), "steps")
    for rest in (None, b.changes().where(late)):
        if rest is not None:
            change_log.write_changes(events_of(rest), root, "orders")
        stream = open_stream(b, root, share_of_files(b, root))
        run_to_parquet(keyed.watch_life_cycles(stream, "key", "status"), root, keyed.start_keyed)
    return keyed.settled_steps(b.spark.read.parquet(f"{root}/out"))


@query("o56_late_data")
def late_data(b):
    # Delivery days run backwards: the oldest events arrive in the last folder.
    backwards = F.date_sub(F.lit("2024-03-01").cast("date"), F.dayofmonth("dt"))
    return upserted(b, write_log(b, b.changes().withColumn("dt", backwards), "late"))


@query("o56_lateness")
def late_deliveries(b):
    """Lateness by delivery day over two runs of a stream, and whether its quantiles hold among all events."""
    delivered = F.date_add("dt", (F.col("lsn") * F.col("lsn") % 11 % 5).cast("int"))
    rows = b.changes().withColumn("dt", delivered)
    early = F.col("lsn") <= middle(b)
    root = write_log(b, rows.where(early), "lateness")
    for rest in (None, rows.where(~early)):
        if rest is not None:
            change_log.write_changes(events_of(rest), root, "orders")
        stream = open_stream(b, root, share_of_files(b, root))
        # A delete carries only its key, so the event time comes from the envelope.
        timed = lateness.with_lateness(stream.withColumn("event_time", as_timestamp((F.col("ts_ms") * 1000).cast("string"))))
        lateness.lateness_stream(timed, f"{root}/late", f"{root}/checkpoint", interval=None).awaitTermination()
    days = lateness.read_lateness(b.spark, f"{root}/late")
    # Ranks of the reported quantiles among all events of their day.
    ranked = lateness.with_lateness(rows).join(days.select("dt", "within"), "dt").groupBy("dt")
    bounds = [
        (F.count_if(F.col("late_seconds") < F.col("within")[i]) / F.count("*") <= share + 0.05)
        & (F.count_if(F.col("late_seconds") <= F.col("within")[i]) / F.count("*") >= share - 0.05)
        for i, share in enumerate(lateness.SHARES)
    ]
    sound = ranked.agg(*(x.alias(f"within_{int(share * 100)}") for x, share in zip(bounds, lateness.SHARES)))
    return days.drop("within", "sketch").join(sound, "dt")


# --- machine learning ------------------------------------------------------


@query("o57_order_features")
def order_features(b):
    return delivery_model.order_features(b.orders(), b.order_items(), b.customers())


@query("o57_delivery_model")
def score_model(b):
    features = delivery_model.order_features(b.orders(), b.order_items(), b.customers())
    path = scratch_dir(b.spark, "model")
    delivery_model.save_model(delivery_model.fit_delivery_model(features), path)
    return delivery_model.score(delivery_model.load_model(path), features)


@query("o57_value_trend")
def value_trend(b):
    """The model on one feature without penalty: an ordinary regression line."""
    features = delivery_model.order_features(b.orders(), b.order_items(), b.customers())
    line = delivery_model.fit_delivery_model(features, ["value"], state_slots=0, penalty=0.0).stages[-1]
    fitted = [(float(line.coefficients[0]), float(line.intercept))]
    found = b.spark.createDataFrame(fitted, "slope double, intercept double")
    return found.select(F.round("slope", 8).alias("slope"), F.round("intercept", 5).alias("intercept"))


@query("o57_held_out_error")
def held_out_error(b):
    """Error on every fifth order of a model of three features, without penalty, fitted on the others."""
    features = delivery_model.order_features(b.orders(), b.order_items(), b.customers())
    held_out = F.col("order_id").cast("bigint") % 5 == 0
    numbers = ["items", "value", "hours_to_approval"]
    model = delivery_model.fit_delivery_model(features.where(~held_out), numbers, state_slots=0, penalty=0.0)
    error = delivery_model.prediction_error(delivery_model.score(model, features.where(held_out)))
    return error.select("n", *(F.round(c, 5).alias(c) for c in ("mean_error", "rmse", "r2")))
