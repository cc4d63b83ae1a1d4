"""Catalog tables: discovery, external tables over files, layer tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import SCHEMAS
from tidemark.sources.change_log import change_log_path, log_schema
from tidemark.sources.csv_files import CSV_OPTIONS, may_hold_line_breaks, snapshot_path
from tidemark.streaming.files import make_folder

LAYERS = ("bronze", "silver", "gold")


def create_layers(spark: SparkSession, root: str, prefix: str = "") -> None:
    """One database per layer, stored below ``root``."""
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}` LOCATION '{root}/{layer}'")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables of one database, temporary views left out."""
    return (
        spark.sql(f"SHOW TABLES IN `{database}`")
        .where(~F.col("isTemporary"))
        .select(F.col("tableName").alias("name"))
    )


def create_snapshot_table(
    spark: SparkSession,
    table: str,
    root: str,
    database: str = "bronze",
    schema: T.StructType | None = None,
) -> str:
    """External table over a snapshot folder; does nothing if it exists.

    A row that does not fit fails the query that reads it. Files are split
    unless the schema has free text or is not given.
    Without ``schema`` Spark infers it, which costs a pass over the files.
    """
    name = f"`{database}`.`{table}_snapshot_external`"
    options = dict(CSV_OPTIONS, path=snapshot_path(root, table), mode="FAILFAST")
    columns = ""
    if schema is None:
        options["inferSchema"] = "true"
    else:
        options["multiLine"] = str(may_hold_line_breaks(schema)).lower()
        # CSV cannot enforce NOT NULL; required columns are a quality rule.
        columns = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ")"
    settings = ", ".join(f"'{k}' = '{v}'" for k, v in options.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {columns} USING csv OPTIONS ({settings})")
    return name


def create_snapshot_tables(
    spark: SparkSession,
    root: str,
    database: str = "bronze",
    schemas: Mapping[str, T.StructType] = SCHEMAS,
) -> dict[str, str]:
    """Fixed-schema external tables for every table of the catalog."""
    return {t: create_snapshot_table(spark, t, root, database, s) for t, s in schemas.items()}


def create_changes_table(
    spark: SparkSession,
    table: str,
    root: str,
    database: str = "bronze",
    schema: T.StructType | None = None,
    folders: Sequence[str] = ("dt",),
) -> str:
    """External table over a change log, partitioned by its folders.

    Event fields beyond ``schema``, the table's schema, are ignored; without
    one Spark infers it from the files. A line that cannot be read fails the
    query; so does a ``null`` line, which only ``read_changes`` passes over. ``folders`` is ``("epoch", "dt")`` where epochs stand above the days.
    Does nothing if the table exists, but for taking up folders that have come
    since. A table without changes yet is empty.
    """
    name = f"`{database}`.`{table}_cdc_external`"
    path = change_log_path(root, table)
    columns = "" if schema is None else f"({log_schema(schema, folders).toDDL()})"
    partitions = "" if schema is None else f"PARTITIONED BY ({', '.join(folders)})"
    if schema is not None:
        make_folder(spark, path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} {columns} USING json "
        f"OPTIONS ('path' = '{path}', 'mode' = 'FAILFAST') {partitions}"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def materialize(
    df: DataFrame,
    layer: str,
    name: str,
    prefix: str = "",
    bucket_keys: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Bronze models become views, silver and gold models tables rebuilt in full.

    A table bucketed by the key it is joined on later needs no shuffle for
    that join. There are as many buckets as the session has shuffle partitions
    unless given. Bucket only by unique keys: a repeated key would put all its
    rows into one writing task. And do not bucket a table that is joined to one
    with very frequent keys: AQE splits those only where both sides are
    shuffled.
    """
    spark = df.sparkSession
    if layer == "bronze":
        view = f"{prefix}{layer}_{name}"
        df.createOrReplaceTempView(view)
        return spark.table(view)
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    full_name = f"`{prefix}{layer}`.`{name}`"
    if bucket_keys:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        # One writing task per bucket instead of one file per bucket and task.
        df = df.repartition(buckets, *bucket_keys)
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_keys:
        writer = writer.bucketBy(buckets, *bucket_keys).sortBy(*bucket_keys)
    writer.saveAsTable(full_name)
    return spark.table(full_name)


def append_rows(df: DataFrame, table: str) -> None:
    """Add rows to a catalog table, columns matched by name."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.mode("append").insertInto(table)
