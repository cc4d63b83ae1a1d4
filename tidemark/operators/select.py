"""Projections, filters, samples and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import CLOSED_STATUSES


def project(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, or all of them."""
    return df.select(*columns) if columns else df.select("*")


def lookup(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose column equals a value; null never matches."""
    return df.where(F.col(column) == F.lit(value))


def open_orders(orders: DataFrame) -> DataFrame:
    """Orders neither delivered nor canceled; a null status is left out."""
    return orders.where(~F.col("order_status").isin(*CLOSED_STATUSES))


def sample_rows(df: DataFrame, percent: float, seed: int, key: str | None = None) -> DataFrame:
    """About ``percent`` of the rows, each drawn on its own; may be empty.

    With ``key`` a hash of it decides, so the choice is the same on every run,
    however the files are split. Rows without key are drawn together, as those of
    any other key are.
    """
    if key is None:
        return df.sample(fraction=percent / 100, seed=seed)
    if percent >= 100:
        return df
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return df.where(F.substring(drawn, 1, 8) < f"{int(percent / 100 * 2**32):08x}")


def sample_files(df: DataFrame, percent: float, seed: int, block: str = r"[^/]*$") -> DataFrame:
    """All rows of about ``percent`` of the blocks of a table in files; the other files are never opened.

    A block is the files whose paths agree in what the pattern ``block`` matches
    first: single files as it stands, folders of a day with ``dt=[^/]+``. A
    hash of it decides, so the choice is the same on every run and, for names that a
    new copy of the table keeps, on every copy. Rows that stand
    together are drawn together. ``df`` must be a plain read of files.
    """
    if percent >= 100:
        return df
    name = F.regexp_extract(F.col("_metadata.file_path"), block, 0)
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), name))
    return df.where(F.substring(drawn, 1, 8) < f"{int(percent / 100 * 2**32):08x}")


def random_top(df: DataFrame, n: int, seed: int, key: str | None = None) -> DataFrame:
    """``n`` rows in random order.

    With ``key`` the order is a hash of it, so the choice is the same on every
    run, however the rows are partitioned. Each task keeps ``n`` rows.
    """
    order = F.rand(seed) if key is None else F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    tie = [] if key is None else [F.col(key)]
    return df.orderBy(order, *tie).limit(n)


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows of an order; the number is required, like the order."""
    if not order:
        raise ValueError("a limit needs an order to be repeatable")
    return df.orderBy(*order).limit(n)


def price_or_default(items: DataFrame, products: DataFrame, default: float) -> DataFrame:
    """Every product with the price of its latest item, or a default price.

    Items of equal shipping limit are ordered by order, item number and price,
    so the result does not depend on row order.
    """
    order: Sequence[str] = ("shipping_limit_date", "order_id", "order_item_id", "price")
    latest = items.where(F.col("price").isNotNull()).groupBy("product_id").agg(F.max(F.struct(*order)).alias("last"))
    return products.select("product_id").join(latest, "product_id", "left").select(
        "product_id", F.coalesce(F.col("last.price"), F.lit(default)).alias("price")
    )


def price_as_of(
    requests: DataFrame,
    items: DataFrame,
    default: float,
    at: str = "at",
    segment_seconds: int = 86_400,
    hot_rows: int = 100_000,
) -> DataFrame:
    """``requests`` with ``price``: that of the product's latest item before ``at``, or a default price.

    ``requests`` has product_id and a time ``at``. Only items of an earlier
    shipping limit count, never one of the same time; items of equal time are
    ordered by order, item number and price. Requests without product or time get
    the default, items without time or price are passed over.

    Requests and items of a product stand in one window. The time of products of more than
    ``hot_rows`` rows is cut into segments, each with a window of its own; over its start
    only the last price of all earlier segments is carried, which enters as one more row. So a
    product with a third of all rows is as many groups as it has segments, the others are
    shuffled once, and nothing is joined but the list of hot products, of which there is
    at most one per ``hot_rows`` rows.
    """
    order = ("shipping_limit_date", "order_id", "order_item_id", "price")
    sold = F.col("product_id").isNotNull() & F.col("shipping_limit_date").isNotNull() & F.col("price").isNotNull()
    answerable = F.col("product_id").isNotNull() & F.col(at).isNotNull()
    # Product and time stand in the row already.
    rest = [c for c in requests.columns if c not in ("product_id", at)]

    def segment(time: str) -> Column:
        days = F.unix_date(F.col(time).cast("date")).cast("bigint")
        seconds = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
        return F.floor((days * 86_400 + seconds) / segment_seconds)

    asked = requests.where(answerable).select(
        "product_id", F.col(at).alias("_at"), F.struct(F.lit(True).alias("_asked"), *rest).alias("_request")
    )
    offered = items.where(sold).select(
        "product_id", F.col("shipping_limit_date").alias("_at"), F.struct(*order[1:]).alias("_item")
    )
    counted = asked.select("product_id").unionByName(offered.select("product_id")).groupBy("product_id").count()
    hot = F.broadcast(counted.where(F.col("count") > hot_rows).select("product_id", F.lit(True).alias("_hot")))

    def placed(rows: DataFrame, how: str) -> DataFrame:
        cut = F.when(F.col("_hot"), segment("_at"))
        return rows.join(hot, "product_id", how).withColumn("_segment", cut).drop("_hot")

    last = placed(offered, "inner").groupBy("product_id", "_segment").agg(F.max(F.struct("_at", "_item")).alias("_last"))
    places = placed(asked, "inner").select("product_id", "_segment").distinct()
    places = last.unionByName(places, allowMissingColumns=True)
    places = places.groupBy("product_id", "_segment").agg(F.max("_last._item").alias("_item"))
    earlier = Window.partitionBy("product_id").orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = places.select("product_id", "_segment", F.last("_item", ignorenulls=True).over(earlier).alias("_item"))

    rows = carried.where(F.col("_item").isNotNull()).withColumn("_kind", F.lit(0))
    rows = rows.unionByName(placed(offered, "left").withColumn("_kind", F.lit(2)), allowMissingColumns=True)
    rows = rows.unionByName(placed(asked, "left").withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    # What is carried has no time and comes first; requests come before items of their time.
    so_far = Window.partitionBy("product_id", "_segment").orderBy(F.col("_at").asc_nulls_first(), "_kind", "_item")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    price = F.coalesce(F.last("_item.price", ignorenulls=True).over(so_far), F.lit(default))
    found = rows.select("product_id", "_at", "_request", price.alias("_price")).where(F.col("_request").isNotNull())
    columns = {"product_id": F.col("product_id"), at: F.col("_at").alias(at)}
    columns |= {c: F.col(f"_request.`{c}`") for c in rest}
    found = found.select(*(columns[c] for c in requests.columns), F.col("_price").alias("price"))
    return found.unionByName(requests.where(~answerable).withColumn("price", F.lit(default)))
