"""Types found in change logs, and how they drift from one delivery day to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.change_log import change_log_path

#: Types as JSON has them, from narrow to wide; a field of two others is a ``variant``.
_WIDENS = ("void", "bigint", "double")

_CASTS = {"bigint": "bigint", "double": "double", "boolean": "boolean"}


def variant_log(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Events of one table as (dt, event), a ``VARIANT`` each; nothing is inferred and no field is lost.

    A line that is no JSON fails the query. ``null`` lines are null payloads and left out.
    """
    lines = spark.read.schema("value string, dt date").text(change_log_path(root, table))
    events = lines.select("dt", F.parse_json("value").alias("event"))
    return events.where(~F.is_variant_null("event"))


def _plain(found: Column) -> Column:
    """The type's name without sizes: every fraction is a double."""
    return F.when(found.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "double").otherwise(F.lower(found))


def field_types(events: DataFrame, by_day: bool = True) -> DataFrame:
    """([dt,] field, type): the narrowest type that holds all values of a field in images of rows.

    ``events`` comes from ``variant_log``. Both images count. A field that is null
    throughout is ``void``, and one of several types that do not widen to each other a
    ``variant``. One aggregation with a partial step: a row per day and field leaves each task.
    """
    images = events.select("dt", F.explode(F.array(*(F.try_variant_get("event", f"$.{i}", "variant") for i in ("before", "after")))).alias("image"))
    images = images.where(F.schema_of_variant("image").startswith("OBJECT"))
    fields = images.lateralJoin(images.sparkSession.tvf.variant_explode(F.col("image").outer()))
    group = ["dt", F.col("key").alias("field")] if by_day else [F.col("key").alias("field")]
    return fields.groupBy(*group).agg(_plain(F.schema_of_variant_agg("value")).alias("type"))


def schema_drift(types: DataFrame) -> DataFrame:
    """(dt, field, change, previous_type, type): fields that differ from the delivery day before.

    ``types`` is ``field_types`` by day. A change is ``added``, ``lost``, ``widened`` (from void
    to any type, from whole numbers to fractions), ``narrowed`` (the reverse) or
    ``changed``. On the first day every field is added. Days without any image do not count.
    """
    order = Window.orderBy("dt")
    # As many rows as there are delivery days.
    days = types.select("dt").distinct()
    days = days.select("dt", F.lag("dt").over(order).alias("_day_before"), F.lead("dt").over(order).alias("_day_after"))
    along = Window.partitionBy("field").orderBy("dt")
    placed = types.join(days, "dt").withColumns(
        {"_seen": F.lag("dt").over(along), "_was": F.lag("type").over(along), "_next": F.lead("dt").over(along)}
    )
    rank = {c: F.array_position(F.array(*map(F.lit, _WIDENS)), F.col(c)) for c in ("type", "_was")}
    known = (rank["type"] > 0) & (rank["_was"] > 0)
    change = (
        F.when(F.col("_seen").isNull() | (F.col("_seen") != F.col("_day_before")), "added")
        .when(F.col("type") == F.col("_was"), None)
        .when((F.col("_was") == "void") | known & (rank["type"] > rank["_was"]), "widened")
        .when((F.col("type") == "void") | known, "narrowed")
        .otherwise("changed")
    )
    held = placed.select("dt", "field", change.alias("change"), F.col("_was").alias("previous_type"), "type")
    held = held.withColumn("previous_type", F.when(F.col("change") != "added", F.col("previous_type")))
    gone = F.col("_day_after").isNotNull() & (F.col("_next").isNull() | (F.col("_next") != F.col("_day_after")))
    lost = placed.where(gone).select(
        F.col("_day_after").alias("dt"),
        "field",
        F.lit("lost").alias("change"),
        F.col("type").alias("previous_type"),
        F.lit(None).cast("string").alias("type"),
    )
    return held.where(F.col("change").isNotNull()).unionByName(lost)


def read_drifted_changes(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Change rows (dt, op, lsn, fields) of a log whose fields drift, each in the type that holds all its values.

    Fields come from the whole log, in order of name; a field that days lack is null
    there. Fields named dt, op or lsn get an underscore. A delete carries the fields of its old image. Whole numbers, fractions and
    truth values are typed, all else is text, numbers in a field of mixed types included. The list of
    fields and types is all that reaches the driver.
    """
    events = variant_log(spark, root, table)
    types = {row.field: row.type for row in field_types(events, by_day=False).collect()}
    images = events.select(
        "dt",
        F.try_variant_get("event", "$.op", "string").alias("op"),
        F.try_variant_get("event", "$.source.lsn", "bigint").alias("lsn"),
        *(F.try_variant_get("event", f"$.{i}", "variant").alias(i) for i in ("before", "after")),
    )
    empty = F.col("after").isNull() | F.is_variant_null("after")
    image = F.when(empty, F.col("before")).otherwise(F.col("after"))
    # As a map, since paths cannot name every field.
    row = images.withColumn("image", F.when(F.schema_of_variant(image).startswith("OBJECT"), image).cast("map<string,variant>"))

    def typed(field: str) -> Column:
        value = F.variant_get(F.element_at("image", F.lit(field)), "$", _CASTS.get(types[field], "string"))
        return value.alias(f"{field}_" if field in ("dt", "op", "lsn") else field)

    return row.select("dt", "op", "lsn", *(typed(f) for f in sorted(types)))
