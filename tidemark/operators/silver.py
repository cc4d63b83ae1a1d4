"""Cleaning and rewriting of reference data and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions import next_status
from tidemark.schemas import DEFAULT_PLACE, STATUS_CHAIN


def geolocation_unique(df: DataFrame) -> DataFrame:
    """One row per zip code: mean position, most frequent city and state.

    Equal frequencies are settled by name. Rows are first reduced to one per
    (zip, city, state), so a zip with very many rows is spread over all tasks.
    Coordinates are summed as decimals, independent of row order.
    """
    zip_code, city, state = "geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"
    spellings = df.groupBy(zip_code, city, state).agg(
        F.count("*").alias("n"),
        *(
            f(c).alias(f"{name}_{c}")
            for c in ("geolocation_lat", "geolocation_lng")
            for name, f in (("sum", lambda c: F.sum(F.col(c).cast("decimal(18,12)"))), ("count", F.count))
        ),
    )

    def mean(c: str):
        total = F.sum(f"sum_{c}").cast("double")
        rows = F.sum(f"count_{c}")
        return F.when(rows > 0, total / rows).alias(c)

    return (
        spellings.groupBy(zip_code)
        .agg(
            mean("geolocation_lat"),
            mean("geolocation_lng"),
            F.min(F.struct((-F.col("n")).alias("rank"), city, state)).alias("place"),
        )
        .select(zip_code, "geolocation_lat", "geolocation_lng", f"place.{city}", f"place.{state}")
    )


def translate_category(products: DataFrame, translation: DataFrame) -> DataFrame:
    """English category names; an untranslated name stays, null stays null."""
    name, english = "product_category_name", "product_category_name_english"
    return products.join(translation.select(name, english), name, "left").select(
        *(F.coalesce(english, name).alias(name) if c == name else F.col(c) for c in products.columns)
    )


def place_or_default(df: DataFrame, places: DataFrame, zip_column: str) -> DataFrame:
    """Adds the place of a zip code, or the fixed default place where it is unknown.

    ``places`` holds one row per zip code, see ``geolocation_unique``.
    """
    zip_code, city, state = DEFAULT_PLACE
    known = places.select(
        F.col("geolocation_zip_code_prefix").alias(zip_column),
        F.col("geolocation_city").alias("_city"),
        F.col("geolocation_state").alias("_state"),
        F.lit(True).alias("_known"),
    )
    found = F.col("_known").isNotNull()
    return df.join(known, zip_column, "left").select(
        *df.columns,
        F.when(found, F.col(zip_column)).otherwise(F.lit(zip_code)).alias("place_zip"),
        F.when(found, F.col("_city")).otherwise(F.lit(city)).alias("place_city"),
        F.when(found, F.col("_state")).otherwise(F.lit(state)).alias("place_state"),
    )


def apply_transition(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Orders after their status events, one step of the life cycle per event.

    ``events``: order_id, lsn, at (timestamp), cancel (boolean); several per
    order are applied by position. Entering approved, shipped or delivered
    sets the timestamp of that milestone. An order in the life cycle cannot
    take more steps than it has, so only its first few events count, and no
    others are shuffled. Any other status is moved by a cancel alone, however
    many events come before it.
    """
    canceled = events.where("cancel").groupBy("order_id").agg(F.lit(True).alias("_ever"))
    steps = len(STATUS_CHAIN) - 1
    ranked = events.withColumn(
        "_step", F.row_number().over(Window.partitionBy("order_id").orderBy("lsn"))
    ).where(F.col("_step") <= steps)
    per_order = ranked.groupBy("order_id").agg(
        F.max("_step").alias("_events"),
        *(F.max(F.when(F.col("_step") == k, F.col("at"))).alias(f"_at{k}") for k in range(1, steps + 1)),
        *(F.max(F.when(F.col("_step") == k, F.col("cancel"))).alias(f"_cancel{k}") for k in range(1, steps + 1)),
    )
    milestones = {
        "approved": "order_approved_at",
        "shipped": "order_delivered_carrier_date",
        "delivered": "order_delivered_customer_date",
    }
    outside = ~F.coalesce(F.col("order_status").isin(STATUS_CHAIN), F.lit(False))
    result = orders.join(per_order, "order_id", "left").join(canceled, "order_id", "left")
    result = result.withColumn("_ever", outside & F.coalesce("_ever", F.lit(False)))
    for k in range(1, steps + 1):
        happened = F.coalesce(F.col("_events") >= k, F.lit(False))
        moved = next_status("order_status", F.coalesce(F.col(f"_cancel{k}"), F.lit(False)))
        result = result.withColumn("_next", F.when(happened, moved).otherwise(F.col("order_status")))
        changed = happened & (F.col("_next") != F.col("order_status"))
        result = result.withColumns(
            {
                column: F.when(changed & (F.col("_next") == status), F.col(f"_at{k}")).otherwise(F.col(column))
                for status, column in milestones.items()
            }
        ).withColumn("order_status", F.col("_next"))
    ended = F.when(F.col("_ever"), next_status("order_status", F.lit(True))).otherwise(F.col("order_status"))
    return result.withColumn("order_status", ended).select(*orders.columns)
