"""Data-quality rules.

Every check gives rows ``table, rule, checked, failed``, also where nothing
fails. Rules that look at one row at a time share one pass over their table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import CANCELED, FOREIGN_KEYS, allowed_transitions, required_columns

# One log segment of 16 MiB: no more positions than this share a window.
LOG_SEGMENT = 1 << 24


def report(*checks: DataFrame) -> DataFrame:
    """All check results in one frame."""
    return reduce(DataFrame.unionByName, checks)


def check_rows(df: DataFrame, table: str, broken: Mapping[str, Column]) -> DataFrame:
    """Row rules in a single pass; each condition is true for a broken row."""
    if not broken:
        return df.sparkSession.createDataFrame([], "table string, rule string, checked bigint, failed bigint")
    counted = df.agg(
        F.count("*").alias("checked"),
        F.array(*(F.struct(F.lit(rule).alias("rule"), F.count_if(c).alias("failed")) for rule, c in broken.items())).alias(
            "rules"
        ),
    )
    return counted.select("checked", F.inline("rules")).select(F.lit(table).alias("table"), "rule", "checked", "failed")


def required_rules(schema: T.StructType) -> dict[str, Column]:
    return {f"required {c}": F.col(c).isNull() for c in required_columns(schema)}


def length_rules(limits: Mapping[str, int]) -> dict[str, Column]:
    return {f"length {c} <= {n}": F.char_length(c) > n for c, n in limits.items()}


def check_required(df: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """Required columns hold no null."""
    return check_rows(df, table, required_rules(schema))


def check_length(df: DataFrame, table: str, limits: Mapping[str, int]) -> DataFrame:
    """Strings stay within their length limit, in characters."""
    return check_rows(df, table, length_rules(limits))


def check_unique(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Keys occur once. Counts keys, not rows; keys with a null part are left to ``check_required``."""
    present = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    per_key = df.where(present).groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.count("*").alias("checked"), F.count_if(F.col("n") > 1).alias("failed")).select(
        F.lit(table).alias("table"), F.lit(f"unique {', '.join(keys)}").alias("rule"), "checked", "failed"
    )


def check_fk(child: DataFrame, table: str, column: str, parent: DataFrame, parent_table: str, parent_column: str) -> DataFrame:
    """Every non-null reference has a parent; counts child rows."""
    return check_fks(parent, parent_table, parent_column, [(child, table, column)])


def check_fks(
    parent: DataFrame, parent_table: str, parent_column: str, children: Sequence[tuple[DataFrame, str, str]]
) -> DataFrame:
    """All references to one parent: a row per child ``(frame, table, column)``.

    Keys and references are counted together, value by value, in one
    aggregation instead of a join per child. Counting starts before the
    shuffle, so a value held by very many rows is one row there.
    """
    values = parent.select(F.col(parent_column).alias("ref"), F.lit(-1).alias("child"))
    for number, (df, _, column) in enumerate(children):
        references = df.where(F.col(column).isNotNull())
        values = values.unionAll(references.select(F.col(column).alias("ref"), F.lit(number).alias("child")))
    numbers = range(len(children))
    per_value = values.groupBy("ref").agg(
        F.max(F.col("child") == -1).alias("found"),
        *(F.count_if(F.col("child") == i).alias(f"rows_{i}") for i in numbers),
    )
    totals = per_value.agg(
        *(F.coalesce(F.sum(f"rows_{i}"), F.lit(0)).alias(f"checked_{i}") for i in numbers),
        *(
            F.coalesce(F.sum(F.when(~F.col("found"), F.col(f"rows_{i}"))), F.lit(0)).alias(f"failed_{i}")
            for i in numbers
        ),
    )
    return totals.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(table).alias("table"),
                        F.lit(f"{column} in {parent_table}").alias("rule"),
                        F.col(f"checked_{i}").alias("checked"),
                        F.col(f"failed_{i}").alias("failed"),
                    )
                    for i, (_, table, column) in enumerate(children)
                )
            )
        )
    )


def check_foreign_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All foreign keys of the fixed schemas, one aggregation per parent."""
    children = defaultdict(list)
    for child, column, parent, key in FOREIGN_KEYS:
        children[parent, key].append((tables[child], child, column))
    return report(*(check_fks(tables[parent], parent, key, refs) for (parent, key), refs in children.items()))


def validate_table(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """Table exists, has exactly the schema's columns and types, and has rows.

    ``checked`` is the row count for the last rule, else 1.
    """
    try:
        table = spark.table(name)
    except AnalysisException as error:
        if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
            raise
        absent = [(name, "present", 1, 1), (name, "schema", 0, 0), (name, "not empty", 0, 0)]
        return spark.createDataFrame(absent, "table string, rule string, checked bigint, failed bigint")
    shape = [(f.name, f.dataType) for f in table.schema.fields]
    fits = shape == [(f.name, f.dataType) for f in schema.fields]
    return table.agg(F.count("*").alias("rows")).select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(name).alias("table"),
                        F.lit(rule).alias("rule"),
                        F.lit(checked).cast("bigint").alias("checked") if not isinstance(checked, Column) else checked.alias("checked"),
                        failed.cast("bigint").alias("failed"),
                    )
                    for rule, checked, failed in (
                        ("present", 1, F.lit(0)),
                        ("schema", 1, F.lit(0 if fits else 1)),
                        ("not empty", F.col("rows"), (F.col("rows") == 0)),
                    )
                )
            )
        )
    )


def with_previous(
    log: DataFrame, key: str, value: str, order: str = "lsn", segment: int = LOG_SEGMENT
) -> DataFrame:
    """``key, order, value`` with the value before it in the key's history.

    ``previous`` is a struct, null at the start of a history. Histories are cut
    into log segments, so not even a key holding most of the log forms one
    group: neighbours are found inside each segment, and only the first and
    last row of each segment are looked at across segments. Positions must be
    unique per key.
    """
    rows = log.select(key, order, value, F.floor(F.col(order) / segment).alias("_segment"))
    # Named explicitly so that both parts below read one and the same shuffle.
    rows = rows.repartition(key, "_segment")
    inside = Window.partitionBy(key, "_segment").orderBy(order)
    before, after = F.lag(F.struct(value)).over(inside), F.lead(F.struct(value)).over(inside)
    across = Window.partitionBy(key).orderBy(order)

    within = rows.withColumn("previous", before).where(F.col("previous").isNotNull())
    ends = rows.withColumns({"_before": before, "_after": after}).where(
        F.col("_before").isNull() | F.col("_after").isNull()
    )
    starts = ends.withColumn("previous", F.lag(F.struct(value)).over(across)).where(F.col("_before").isNull())
    columns = [key, order, value, "previous"]
    return within.select(*columns).unionAll(starts.select(*columns))


def illegal_transitions(
    changes: DataFrame,
    key: str = "order_id",
    status: str = "order_status",
    order: str = "lsn",
    segment: int = LOG_SEGMENT,
) -> DataFrame:
    """Steps the life cycle does not allow: key, position, previous, status, is_first.

    Takes a log without redeliveries.
    """
    steps = with_previous(changes, key, status, order, segment)
    previous = F.col(f"previous.{status}")
    is_first = F.col("previous").isNull()
    allowed = reduce(
        lambda a, b: a | b,
        (
            (is_first if before is None else previous.eqNullSafe(before)) & F.col(status).eqNullSafe(after)
            for before, after in allowed_transitions()
        ),
    )
    return steps.where(~allowed).select(
        key, order, previous.alias("previous_status"), F.col(status).alias("status"), is_first.alias("is_first")
    )


def milestone_rules() -> dict[str, Column]:
    """Status and timestamps of an order agree. Imported history may break these: report, do not reject."""
    status = F.col("order_status")
    purchase, approved, carrier, customer = (
        F.col(c)
        for c in (
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
        )
    )
    return {
        "created without later milestones": (status == "created")
        & (approved.isNotNull() | carrier.isNotNull() | customer.isNotNull()),
        "approved at once past approval": status.isin("approved", "processing", "invoiced", "shipped", "delivered")
        & approved.isNull(),
        "handed over once shipped": status.isin("shipped", "delivered") & carrier.isNull(),
        "received once delivered": (status == "delivered") & customer.isNull(),
        "approval after purchase": approved < purchase,
        "hand-over after approval": carrier < approved,
        "receipt after hand-over": customer < carrier,
    }


def check_milestones(orders: DataFrame, table: str = "orders") -> DataFrame:
    return check_rows(orders, table, milestone_rules())


def payment_rules() -> dict[str, Column]:
    """What one payment row must keep to."""
    instalments = F.col("payment_installments")
    card = F.col("payment_type") == "credit_card"
    return {
        "one payment per order": F.col("payment_sequential") != 1,
        "1 to 10 instalments by card": card & ~instalments.between(1, 10),
        "one instalment otherwise": ~card & (instalments != 1),
    }


def item_rules() -> dict[str, Column]:
    """What one item row must keep to."""
    return {
        "price from 10 to 300": ~F.col("price").between(10, 300),
        "freight from 5 to 50": ~F.col("freight_value").between(5, 50),
    }


def review_rules() -> dict[str, Column]:
    """What one review row must keep to."""
    return {"answer not before creation": F.col("review_answer_timestamp") < F.col("review_creation_date")}


def estimate_rules() -> dict[str, Column]:
    """What the estimate of an order must keep to."""
    purchase, estimate = F.col("order_purchase_timestamp"), F.col("order_estimated_delivery_date")
    early = estimate < purchase + F.expr("INTERVAL '10' DAY")
    return {"estimate 10 to 20 days after purchase": early | (estimate > purchase + F.expr("INTERVAL '20' DAY"))}


def check_write_rules(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rules that rows written by the shop keep to; imported history may not. A null breaks none.

    Reviews and items are compared with their order by a join; prices of a
    product and places of a buyer are reduced before anything is shuffled.
    """
    orders = tables["orders"]
    headers = orders.select("order_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date")
    reviews = tables["order_reviews"].select("order_id", "review_creation_date").join(headers, "order_id")
    items = tables["order_items"].select("order_id", "shipping_limit_date").join(headers, "order_id")
    limit = F.col("order_purchase_timestamp") + F.expr("INTERVAL '5' DAY")
    prices = tables["order_items"].groupBy("product_id").agg(F.min("price").alias("low"), F.max("price").alias("high"))
    place = [f"customer_{c}" for c in ("zip_code_prefix", "city", "state")]
    buyers = tables["customers"].groupBy("customer_unique_id").agg(
        *(side(c).alias(f"{name}_{c}") for c in place for name, side in (("low", F.min), ("high", F.max)))
    )
    moved = reduce(lambda a, b: a | b, (F.coalesce(F.col(f"low_{c}") != F.col(f"high_{c}"), F.lit(False)) for c in place))
    return report(
        check_rows(tables["payments"], "payments", payment_rules()),
        check_rows(tables["order_items"], "order_items", item_rules()),
        check_rows(tables["order_reviews"], "order_reviews", review_rules()),
        check_rows(orders, "orders", estimate_rules()),
        check_rows(
            reviews,
            "order_reviews",
            {
                "reviewed once delivered": F.col("order_status") != "delivered",
                "review after receipt": F.col("review_creation_date") < F.col("order_delivered_customer_date"),
            },
        ),
        check_rows(items, "order_items", {"shipping limit 5 days after purchase": F.col("shipping_limit_date") != limit}),
        check_rows(prices, "products", {"one price per product": F.col("low") != F.col("high")}),
        check_rows(buyers, "customers", {"returning buyers keep their place": moved}),
    )


def check_payments(reconciled: DataFrame) -> DataFrame:
    """Orders whose payments equal their items, from ``reconcile_payments``."""
    return check_rows(reconciled, "orders", {"paid what is owed": F.col("outcome") != "match"})


def check_transitions(changes: DataFrame, table: str) -> DataFrame:
    """Steps of the orders' life cycle in a log without redeliveries, see ``illegal_transitions``.

    Unlike there, a history may start anywhere, as its beginning can lie in the
    snapshot or before a delete, and a change that leaves the status alone is no step.
    """
    illegal = illegal_transitions(changes).where(F.col("previous_status") != F.col("status"))
    counts = changes.agg(F.count("*").alias("checked")), illegal.agg(F.count("*").alias("failed"))
    return counts[0].select(
        F.lit(table).alias("table"), F.lit("legal transitions").alias("rule"), "checked", counts[1].scalar().alias("failed")
    )


def check_item_sequence(items: DataFrame, table: str = "order_items") -> DataFrame:
    """Item numbers of each order are 1, 2, … n; counts orders."""
    numbers = items.groupBy("order_id", "order_item_id").agg(F.count("*").alias("n"))
    per_order = numbers.groupBy("order_id").agg(
        F.min("order_item_id").alias("low"),
        F.max("order_item_id").alias("high"),
        F.count("order_item_id").alias("different"),
        F.sum("n").alias("rows"),
    )
    sound = (F.col("low") == 1) & (F.col("high") == F.col("rows")) & (F.col("different") == F.col("rows"))
    return per_order.agg(
        F.count("*").alias("checked"), F.count_if(~F.coalesce(sound, F.lit(False))).alias("failed")
    ).select(F.lit(table).alias("table"), F.lit("item numbers contiguous").alias("rule"), "checked", "failed")


def mix_profile(
    df: DataFrame, column: str, targets: Mapping[object, float], weight: str | None = None
) -> DataFrame:
    """Share of each value next to its target share: value, n, share, target.

    Rows count once, or as often as the column ``weight`` says. ``targets``
    need not add up to anything. Values without target, and targets without
    value, are kept.
    """
    spark = df.sparkSession
    number = F.count("*") if weight is None else F.sum(weight)
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(number.alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    whole = sum(targets.values())
    wanted = spark.createDataFrame(
        [(str(v).lower() if isinstance(v, bool) else str(v), w / whole) for v, w in targets.items()],
        "value string, target double",
    )
    n = F.coalesce("n", F.lit(0))
    return counts.join(wanted, "value", "full_outer").select("value", n.alias("n"), (n / total).alias("share"), "target")


def items_per_order(items: DataFrame) -> DataFrame:
    """Number of items of each order, for ``mix_profile``."""
    return items.groupBy("order_id").agg(F.count("*").alias("items"))


def returning_buyers(customers: DataFrame) -> DataFrame:
    """Orders by new and by returning persons, for ``mix_profile`` with weight ``n``.

    A person's first customer row is new, every further one returning.
    """
    per_person = customers.groupBy("customer_unique_id").agg(F.count("*").alias("rows"))
    return per_person.select(
        F.inline(
            F.array(
                F.struct(F.lit(False).alias("returning"), F.lit(1).cast("bigint").alias("n")),
                F.struct(F.lit(True).alias("returning"), (F.col("rows") - 1).alias("n")),
            )
        )
    )


def reviewed_orders(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Whether each delivered order has a review, for ``mix_profile``."""
    rated = reviews.groupBy("order_id").agg(F.lit(True).alias("reviewed"))
    delivered = orders.where("order_status = 'delivered'").select("order_id")
    return delivered.join(rated, "order_id", "left").select(F.col("reviewed").isNotNull().alias("reviewed"))


def cancelled_steps(
    changes: DataFrame, key: str = "order_id", status: str = "order_status", order: str = "lsn", segment: int = LOG_SEGMENT
) -> DataFrame:
    """Whether each step of an order not yet shipped cancels it, for ``mix_profile``.

    Takes a log without redeliveries; a change that leaves the status alone is no step.
    """
    steps = with_previous(changes, key, status, order, segment)
    open_before = F.col(f"previous.{status}").isin([before for before, after in allowed_transitions() if after == CANCELED])
    moved = F.col(status) != F.col(f"previous.{status}")
    return steps.where(open_before & moved).select((F.col(status) == CANCELED).alias("cancelled"))
