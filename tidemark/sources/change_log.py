"""Change-log files: one JSON event per line, a folder per table and delivery day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import micros_of
from tidemark.schemas import CDC_TABLES


def change_log_path(root: str, table: str) -> str:
    return f"{root}/{table}/cdc"


def wire_schema(table_schema: T.StructType) -> T.StructType:
    """Types of a row image on the wire.

    Timestamps arrive as integer microseconds or ISO text; as strings both
    are kept until ``normalize``. Nothing is required: a delete may carry
    only its key.
    """
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if _is_time(f.dataType) else f.dataType)
            for f in table_schema.fields
        ]
    )


def _is_time(kind: T.DataType) -> bool:
    return isinstance(kind, (T.TimestampType, T.TimestampNTZType))


def envelope_schema(table_schema: T.StructType) -> T.StructType:
    """Schema of one event line, without the ``dt`` folder column."""
    image = wire_schema(table_schema)
    source = T.StructType(
        [
            T.StructField("lsn", T.LongType()),
            T.StructField("txId", T.LongType()),
            T.StructField("ts_ms", T.LongType()),
            T.StructField("schema", T.StringType()),
            T.StructField("table", T.StringType()),
        ]
    )
    return T.StructType(
        [
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("source", source),
        ]
    )


_FOLDERS = {
    "dt": T.StructField("dt", T.DateType()),
    "epoch": T.StructField("epoch", T.IntegerType()),
}


#: Column with the text of a line that is no event or does not fit its types.
UNREADABLE = "unreadable"


def log_schema(
    table_schema: T.StructType, folders: Sequence[str] = ("dt",), unreadable: bool = False
) -> T.StructType:
    """Schema of a stored event: the event line plus its folder columns."""
    kept = [T.StructField(UNREADABLE, T.StringType())] if unreadable else []
    return T.StructType([*envelope_schema(table_schema).fields, *kept, *(_FOLDERS[f] for f in folders)])


LINE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE}


def is_faulty(events: DataFrame) -> Column:
    """True for a line that does not fit the schema, or an event without operation.

    A ``null`` line is a null payload and no fault. All parts of the event are
    named, so a misfit in any of them is seen, whatever columns are used later.
    """
    content = F.col("before").isNotNull() | F.col("after").isNotNull() | F.col("source").isNotNull()
    faulty = F.col("op").isNull() & content
    if UNREADABLE in events.columns:
        faulty = faulty | F.coalesce(F.trim(UNREADABLE) != "null", F.lit(False))
    return faulty


def fail_on_faulty(events: DataFrame) -> DataFrame:
    """The events without the column ``unreadable``; a faulty one fails the query."""
    what = F.concat(F.lit("unreadable event: "), F.coalesce(UNREADABLE, F.lit("no operation")))
    sound = F.when(is_faulty(events), F.raise_error(what).cast("boolean")).otherwise(F.lit(True))
    return events.where(sound).drop(UNREADABLE)


def read_changes(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType | None = None,
    folders: Sequence[str] = ("dt",),
    keep_unreadable: bool = False,
) -> DataFrame:
    """Events of one table, with the delivery day ``dt`` as a column.

    ``schema`` is the table's schema; event fields beyond it are ignored.
    Without one the schema is inferred, which costs a pass over every file.
    Filters on folder columns skip whole folders.

    A line that is cut off or does not fit the schema fails the query that
    reads it. With ``keep_unreadable`` it becomes a row with its text in the
    column ``unreadable`` instead. Without a schema nothing can be checked.
    """
    path = change_log_path(root, table)
    if schema is None:
        return spark.read.json(path)
    events = spark.read.options(**LINE_OPTIONS).schema(log_schema(schema, folders, unreadable=True)).json(path)
    return events if keep_unreadable else fail_on_faulty(events)


def read_changes_or_empty(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType,
    folders: Sequence[str] = ("dt",),
    keep_unreadable: bool = False,
) -> DataFrame:
    """Like ``read_changes``, but a table without a folder is an empty log."""
    try:
        return read_changes(spark, root, table, schema, folders, keep_unreadable)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], log_schema(schema, folders, keep_unreadable))


def to_envelope(
    rows: DataFrame,
    table_schema: T.StructType,
    table: str,
    keys: Sequence[str],
    namespace: str = "public",
) -> DataFrame:
    """Events in wire form from flat rows ``op, lsn, ts_ms, <columns>[, epoch, dt]``.

    A delete carries only its key, in ``before``.
    """
    image = []
    for f in table_schema.fields:
        value = F.col(f.name)
        image.append((micros_of(value).cast("string") if _is_time(f.dataType) else value).alias(f.name))
    key_only = [c if f.name in keys else F.lit(None).cast(wire_schema(table_schema)[f.name].dataType).alias(f.name)
                for c, f in zip(image, table_schema.fields)]
    deleted = F.col("op") == "d"
    folders = [F.col(f) for f in ("epoch", "dt") if f in rows.columns]
    return rows.select(
        "op",
        "ts_ms",
        F.when(deleted, F.struct(*key_only)).alias("before"),
        F.when(~deleted, F.struct(*image)).alias("after"),
        F.struct(
            F.col("lsn"),
            F.col("lsn").alias("txId"),
            F.col("ts_ms"),
            F.lit(namespace).alias("schema"),
            F.lit(table).alias("table"),
        ).alias("source"),
        *folders,
    )


def write_changes(events: DataFrame, root: str, table: str, mode: str = "append", rows_per_file: int = 1_000_000) -> str:
    """Add events to the table's log; ``events`` needs the column ``dt``.

    An ``epoch`` column becomes a folder above the days. The rebalance hint
    gathers each folder into few files and splits folders that are too large
    for one task.
    """
    path = change_log_path(root, table)
    folders = [f for f in ("epoch", "dt") if f in events.columns]
    (
        events.hint("rebalance", *folders)
        .write.mode(mode)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*folders)
        .json(path)
    )
    return path


def cdc_tables(all_tables: DataFrame, selected: Sequence[str] = tuple(CDC_TABLES)) -> DataFrame:
    """Those discovered tables (column ``name``) whose changes are delivered."""
    return all_tables.join(_names(all_tables.sparkSession, selected, "name"), "name", "left_semi")


def route_changes(events: DataFrame, database: str, tables: Sequence[str] = tuple(CDC_TABLES)) -> DataFrame:
    """Events of the captured tables with their topic ``database.schema.table``.

    Adds the columns ``table`` and ``topic``; works on batches and streams.
    """
    names = _names(events.sparkSession, tables, "table")
    return (
        events.withColumn("table", F.col("source.table"))
        .join(F.broadcast(names), "table", "left_semi")
        .withColumn("topic", F.concat_ws(".", F.lit(database), F.col("source.schema"), F.col("table")))
    )


def _names(spark: SparkSession, names: Sequence[str], column: str) -> DataFrame:
    """The configured table names; a handful, so safe to broadcast."""
    return spark.createDataFrame([(n,) for n in names], f"`{column}` string")
