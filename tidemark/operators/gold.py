"""Star schema: dimensions, facts and order-level measures.

Facts carry integer yyyymmdd date keys, computed rather than joined. No join
here is hinted: Spark broadcasts a side whose measured size allows it and
otherwise sorts both, splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cents, date_key, elapsed_hours, money, price
from tidemark.operators.silver import translate_category

ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def _located(df: DataFrame, places: DataFrame, zip_column: str) -> DataFrame:
    coordinates = places.select(
        F.col("geolocation_zip_code_prefix").alias(zip_column),
        F.col("geolocation_lat").alias("lat"),
        F.col("geolocation_lng").alias("lng"),
    )
    return df.join(coordinates, zip_column, "left").select(*df.columns, "lat", "lng")


def dim_customers(customers: DataFrame, places: DataFrame) -> DataFrame:
    """One row per customer_id, which is one per order; the person is customer_unique_id."""
    return _located(customers, places, "customer_zip_code_prefix")


def dim_sellers(sellers: DataFrame, places: DataFrame) -> DataFrame:
    return _located(sellers, places, "seller_zip_code_prefix")


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with English category names."""
    return translate_category(products, translation)


def dim_date(orders: DataFrame) -> DataFrame:
    """Every day from the first to the last date found in the orders."""
    times = [F.col(c).cast("date") for c in ORDER_TIMES]
    span = orders.agg(F.min(F.least(*times)).alias("first"), F.max(F.greatest(*times)).alias("last"))
    day = F.col("date")
    weekday = F.weekday(day) + 1
    return span.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("date")
    ).select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("iso_week"),
        weekday.alias("weekday"),
        (weekday >= 6).alias("is_weekend"),
    )


def _late() -> Column:
    return F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")


def order_durations(orders: DataFrame) -> DataFrame:
    """Whole hours between milestones, null where one is missing, and lateness against the estimate."""
    purchase, approved, carrier, customer, estimated = ORDER_TIMES
    return orders.select(
        "order_id",
        elapsed_hours(purchase, approved).alias("hours_to_approval"),
        elapsed_hours(approved, carrier).alias("hours_to_carrier"),
        elapsed_hours(carrier, customer).alias("hours_to_customer"),
        elapsed_hours(purchase, customer).alias("hours_total"),
        elapsed_hours(estimated, customer).alias("hours_past_estimate"),
        _late().alias("is_late"),
    )


def fact_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order with its buyer and date keys."""
    buyers = customers.select("customer_id", "customer_unique_id")
    return orders.join(buyers, "customer_id", "left").select(
        "order_id",
        "customer_id",
        "customer_unique_id",
        "order_status",
        *(date_key(c).alias(f"{name}_date_key") for name, c in zip(
            ("purchase", "approved", "carrier", "delivered", "estimated"), ORDER_TIMES)),
        _late().alias("is_late"),
    )


def fact_order_items(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per item with order, buyer and date; price, freight and their sum.

    Items whose order is missing stay, without its columns. Orders meet
    customers first, so the items, the largest table, are shuffled once.
    """
    buyers = customers.select("customer_id", "customer_unique_id")
    headers = (
        orders.select("order_id", "customer_id", "order_status", "order_purchase_timestamp")
        .join(buyers, "customer_id", "left")
        .select(
            "order_id",
            "customer_id",
            "customer_unique_id",
            "order_status",
            date_key("order_purchase_timestamp").alias("purchase_date_key"),
        )
    )
    return items.join(headers, "order_id", "left").select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "customer_id",
        "customer_unique_id",
        "order_status",
        "purchase_date_key",
        date_key("shipping_limit_date").alias("shipping_limit_date_key"),
        price("price").alias("price"),
        price("freight_value").alias("freight"),
        (price("price") + price("freight_value")).alias("price_and_freight"),
    )


def fact_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per payment with its order's buyer and date."""
    headers = orders.select(
        "order_id", "customer_id", date_key("order_purchase_timestamp").alias("purchase_date_key")
    )
    return payments.join(headers, "order_id", "left").select(
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "customer_id",
        "purchase_date_key",
        price("payment_value").alias("payment_value"),
    )


def fact_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per review with its order's buyer, dates, and the size of its text."""
    headers = orders.select(
        "order_id", "customer_id", date_key("order_purchase_timestamp").alias("purchase_date_key")
    )
    return reviews.join(headers, "order_id", "left").select(
        "review_id",
        "order_id",
        "customer_id",
        "purchase_date_key",
        date_key("review_creation_date").alias("review_date_key"),
        "review_score",
        F.char_length("review_comment_message").alias("message_length"),
        elapsed_hours("review_creation_date", "review_answer_timestamp").alias("hours_to_answer"),
    )


def _item_sums(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count("*").alias("items"),
        F.sum(cents("price")).alias("price"),
        F.sum(cents("freight_value")).alias("freight"),
    )


def order_totals(items: DataFrame) -> DataFrame:
    """Number of items, price, freight and total of each order."""
    return _item_sums(items).select(
        "order_id",
        "items",
        money("price").alias("price"),
        money("freight").alias("freight"),
        money(F.coalesce("price", F.lit(0)) + F.coalesce("freight", F.lit(0))).alias("total"),
    )


def reconcile_payments(items: DataFrame, payments: DataFrame, tolerance_cents: int = 1) -> DataFrame:
    """Paid value against item total, per order.

    Both sides are many per order, so each is summed before they meet; the
    sums are already partitioned by order and the join adds no shuffle.
    ``outcome``: match, mismatch, no items, no payment.
    """
    owed = _item_sums(items).select(
        "order_id", "items", (F.coalesce("price", F.lit(0)) + F.coalesce("freight", F.lit(0))).alias("owed")
    )
    paid = payments.groupBy("order_id").agg(F.sum(cents("payment_value")).alias("paid"))
    gap = F.abs(F.col("paid") - F.col("owed"))
    outcome = (
        F.when(F.col("items").isNull(), F.lit("no items"))
        .when(F.col("paid").isNull(), F.lit("no payment"))
        .when(gap <= tolerance_cents, F.lit("match"))
        .otherwise(F.lit("mismatch"))
    )
    return owed.join(paid, "order_id", "full_outer").select(
        "order_id",
        F.coalesce("items", F.lit(0)).alias("items"),
        money("owed").alias("total"),
        money("paid").alias("paid"),
        outcome.alias("outcome"),
    )
