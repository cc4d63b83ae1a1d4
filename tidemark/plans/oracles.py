"""The registered queries in SQL, for comparison on another engine.

Written from the operators' meaning, not from their code: windows and
QUALIFY where the operators aggregate, unions where they join.
"""

from __future__ import annotations

import re

# Shapes of FIXTURES.md, as a WITH list over the raw tables.
SHAPES = {
    "customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_custkey % 1000 AS VARCHAR) AS customer_unique_id,
               c_nationkey AS customer_zip_code_prefix, n_name AS customer_city, r_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, s_nationkey AS seller_zip_code_prefix,
               n_name AS seller_city, r_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "geolocation": """
        SELECT c_nationkey AS geolocation_zip_code_prefix, c_acctbal / 100 AS geolocation_lat,
               -c_acctbal / 50 AS geolocation_lng,
               CASE WHEN c_custkey % 3 = 0 THEN upper(n_name) ELSE lower(n_name) END AS geolocation_city,
               r_name AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "product_category_name_translation": """
        SELECT * FROM (VALUES ('ECONOMY', 'economy'), ('LARGE', 'large'), ('MEDIUM', 'medium'),
                              ('PROMO', 'promotion'), ('SMALL', 'small'))
                 AS t(product_category_name, product_category_name_english)""",
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_type END AS product_category_name,
               CAST(length(p_name) AS INT) AS product_name_length, p_size AS product_weight_g,
               p_retailprice AS product_length_cm
        FROM part""",
    "orders_v": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'shipped' ELSE 'created' END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 100 <> 7 THEN o_orderdate + INTERVAL '6' HOUR END AS order_approved_at,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL '2' DAY END AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL '9' DAY
                    WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '5' DAY END AS order_delivered_customer_date,
               o_orderdate + INTERVAL '8' DAY AS order_estimated_delivery_date
        FROM orders""",
    "order_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_shipdate AS shipping_limit_date, l_extendedprice AS price,
               round(l_extendedprice * l_tax, 2) AS freight_value
        FROM lineitem""",
    "payments": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 1 AS payment_sequential,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'voucher' WHEN '2' THEN 'debit_card'
                    WHEN '3' THEN 'boleto' ELSE 'credit_card' END AS payment_type,
               1 AS payment_installments,
               CASE WHEN t IS NULL OR o_orderkey % 10 = 0 THEN o_totalprice ELSE CAST(t AS DOUBLE) END AS payment_value
        FROM orders LEFT JOIN (
            SELECT order_id, sum(CAST(price AS DECIMAL(18,2)) + CAST(freight_value AS DECIMAL(18,2))) AS t
            FROM order_items GROUP BY order_id) x ON CAST(o_orderkey AS VARCHAR) = x.order_id""",
    "order_reviews": """
        SELECT CAST(conv_id AS VARCHAR) AS review_id, CAST(conv_id AS VARCHAR) AS order_id,
               CAST(1 + length(text) % 5 AS INT) AS review_score, CAST(NULL AS VARCHAR) AS review_comment_title,
               text AS review_comment_message,
               TIMESTAMP '1995-01-01' + to_days(CAST(conv_id * 53 % 2400 AS INT)) AS review_creation_date,
               CASE WHEN turn % 4 <> 3 THEN TIMESTAMP '1995-01-01' + to_days(CAST(conv_id * 53 % 2400 AS INT))
                    + to_hours(CAST(turn * 7 - 3 AS INT)) END AS review_answer_timestamp
        FROM conversations""",
    "changes": """
        SELECT event_id AS lsn, user_id AS key, ts AS event_time, CAST(ts AS DATE) AS dt,
               CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
               CASE event_type WHEN 'signup' THEN 'created' WHEN 'view' THEN 'approved' WHEN 'click' THEN 'processing'
                    WHEN 'purchase' THEN 'shipped' ELSE 'canceled' END AS status,
               value
        FROM events""",
    "accounts": "SELECT c_custkey AS key, 'created' AS status, c_acctbal AS value FROM customer",
    "bound": "SELECT max(lsn) // 2 AS middle FROM changes",
    "places": """
        SELECT a.zip AS geolocation_zip_code_prefix, a.lat AS geolocation_lat, a.lng AS geolocation_lng,
               p.geolocation_city, p.geolocation_state
        FROM (SELECT geolocation_zip_code_prefix AS zip,
                     CAST(sum(CAST(geolocation_lat AS DECIMAL(18,6))) AS DOUBLE) / count(geolocation_lat) AS lat,
                     CAST(sum(CAST(geolocation_lng AS DECIMAL(18,6))) AS DOUBLE) / count(geolocation_lng) AS lng
              FROM geolocation GROUP BY 1) a
        JOIN (SELECT geolocation_zip_code_prefix, geolocation_city, geolocation_state
              FROM geolocation GROUP BY geolocation_zip_code_prefix, geolocation_city, geolocation_state
              QUALIFY row_number() OVER (PARTITION BY geolocation_zip_code_prefix
                      ORDER BY count(*) DESC, geolocation_city, geolocation_state) = 1) p
          ON a.zip = p.geolocation_zip_code_prefix""",
    "tables_v": " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS rows FROM {source}"
        for name, source in (
            ("product_category_name_translation", "product_category_name_translation"),
            ("geolocation", "customer"),
            ("sellers", "supplier"),
            ("customers", "customer"),
            ("products", "part"),
            ("orders", "orders"),
            ("order_items", "lineitem"),
            ("payments", "orders"),
            ("order_reviews", "order_reviews"),
        )
    ),
}

DATE_KEY = "CAST(strftime({0}, '%Y%m%d') AS INT)"
STATE = "key, lsn, op, status, {event_time}, value"


def with_shapes(sql: str) -> str:
    """Prefix the shapes the query names, and those they need."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in SHAPES.items():
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(body)
                needed.append(name)

    visit(sql)
    shapes = ",\n".join(f"{name} AS ({SHAPES[name].strip()})" for name in needed)
    if not shapes:
        return sql
    recursive = "RECURSIVE " if "-- recursive" in sql else ""
    extra = re.match(r"\s*(?:-- recursive)?\s*WITH\s+", sql)
    body = sql[extra.end():] if extra else sql
    return f"WITH {recursive}{shapes}{', ' if extra else ' '}{body}"


def date_key(column: str) -> str:
    return DATE_KEY.format(column)


def hours(start: str, end: str) -> str:
    return f"CAST(floor(date_diff('microsecond', {start}, {end}) / 3600000000.0) AS BIGINT)"


ALL_ORDERS = """order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
    order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date"""

# A delete travels with its key only.
IMAGE = """lsn, key, op, CASE WHEN op <> 'd' THEN status END AS status,
    CASE WHEN op <> 'd' THEN event_time END AS event_time, CASE WHEN op <> 'd' THEN value END AS value"""

FULL_PRODUCTS = """product_id, {category} AS product_category_name, product_name_length,
    CAST(NULL AS INT) AS product_description_length, CAST(NULL AS INT) AS product_photos_qty, product_weight_g,
    product_length_cm, CAST(NULL AS DOUBLE) AS product_height_cm, CAST(NULL AS DOUBLE) AS product_width_cm"""

LATEST = """
    SELECT key, lsn, op, status, event_time, value FROM changes
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY lsn DESC) = 1"""

# State of the accounts after the changes that satisfy a condition.
ACCOUNTS_AFTER = """
    SELECT key, status, value FROM (
        SELECT key, status, value, op, row_number() OVER (PARTITION BY key ORDER BY lsn DESC) AS n
        FROM (SELECT key, status, value, 'r' AS op, -1 AS lsn FROM accounts
              UNION ALL
              SELECT key, status, value, op, lsn FROM changes WHERE {0}) everything) ranked
    WHERE n = 1 AND op <> 'd'"""

PAYLOAD = """CAST(sum(key) AS BIGINT) AS sum_key,
    CAST(sum(length(status)) FILTER (WHERE op <> 'd') AS BIGINT) AS status_chars,
    CAST(sum(epoch_us(event_time) % 1000000000) FILTER (WHERE op <> 'd') AS BIGINT) AS sum_micros,
    CAST(sum(CAST(floor(value * 100) AS BIGINT)) FILTER (WHERE op <> 'd') AS BIGINT) AS sum_cents"""

ROUTED = """
    SELECT lsn, op, dt, key, status, event_time, value, CASE WHEN op = 'd' THEN 'payments' WHEN status = 'created' THEN 'customers'
        WHEN status = 'approved' THEN 'geolocation' WHEN status = 'processing' THEN 'order_items'
        WHEN status = 'shipped' THEN 'orders' ELSE 'payments' END AS "table" FROM changes"""

DIM_PLACE = """
    SELECT {columns}, geolocation_lat AS lat, geolocation_lng AS lng
    FROM {table} LEFT JOIN places ON {zip} = geolocation_zip_code_prefix"""

TOTALS = """
    SELECT order_id, count(*) AS items, sum(CAST(price AS DECIMAL(18,2))) AS price,
           sum(CAST(freight_value AS DECIMAL(18,2))) AS freight
    FROM order_items GROUP BY order_id"""

MIX = """
    SELECT '{profile}' AS profile, coalesce(v.value, t.value) AS value, coalesce(n, 0) AS n,
           coalesce(n, 0) / (SELECT sum(n) FROM ({counts})) AS share, target
    FROM ({counts}) v FULL JOIN (SELECT * FROM (VALUES {targets}) AS t(value, target)) t ON v.value = t.value"""


def rule(table: str, name: str, failed: str, checked: str = "count(*)", source: str | None = None) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{name}' AS rule, CAST({checked} AS BIGINT) AS checked,"
        f" CAST({failed} AS BIGINT) AS failed FROM {source or table}"
    )


def row_rules(table: str, rules: dict[str, str], source: str | None = None) -> list[str]:
    return [rule(table, name, f"count(*) FILTER ({broken})", source=source) for name, broken in rules.items()]


def unique_rule(table: str, keys: str, source: str | None = None) -> str:
    return rule(table, f"unique {keys}", "count(*) FILTER (n > 1)", source=f"(SELECT count(*) AS n FROM {source or table} GROUP BY {keys})")


def fk_rule(child: str, column: str, parent: str, key: str, child_source: str | None = None, parent_source: str | None = None) -> str:
    return (
        f"SELECT '{child}' AS \"table\", '{column} in {parent}' AS rule, count({column}) AS checked,"
        f" CAST(count({column}) - (SELECT count(*) FROM {child_source or child} c"
        f" WHERE c.{column} IN (SELECT p.{key} FROM {parent_source or parent} p)) AS BIGINT) AS failed"
        f" FROM {child_source or child}"
    )


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def mixes() -> str:
    profiles = [
        ("payment type", "SELECT payment_type AS value, count(*) AS n FROM payments GROUP BY 1",
         "('credit_card', 0.74), ('boleto', 0.19), ('voucher', 0.055), ('debit_card', 0.015)"),
        ("items per order",
         "SELECT CAST(c AS VARCHAR) AS value, count(*) AS n FROM (SELECT count(*) AS c FROM order_items GROUP BY order_id) GROUP BY 1",
         "('1', 0.8), ('2', 0.15), ('3', 0.05)"),
        ("review score", "SELECT CAST(review_score AS VARCHAR) AS value, count(*) AS n FROM order_reviews GROUP BY 1",
         "('5', 0.5), ('4', 0.2), ('3', 0.1), ('2', 0.1), ('1', 0.1)"),
        ("reviewed",
         "SELECT CAST(order_id IN (SELECT order_id FROM order_reviews) AS VARCHAR) AS value, count(*) AS n "
         "FROM orders_v WHERE order_status = 'delivered' GROUP BY 1", "('true', 0.4), ('false', 0.6)"),
        ("review with title",
         "SELECT CAST(review_comment_title IS NOT NULL AS VARCHAR) AS value, count(*) AS n FROM order_reviews GROUP BY 1",
         "('true', 0.5), ('false', 0.5)"),
        ("review with text",
         "SELECT CAST(review_comment_message IS NOT NULL AS VARCHAR) AS value, count(*) AS n FROM order_reviews GROUP BY 1",
         "('true', 0.7), ('false', 0.3)"),
        ("returning buyer",
         "SELECT CASE WHEN first THEN 'false' ELSE 'true' END AS value, count(*) AS n FROM ("
         "SELECT row_number() OVER (PARTITION BY customer_unique_id) = 1 AS first FROM customers) GROUP BY 1",
         "('true', 0.85), ('false', 0.15)"),
    ]
    return union([_mix(*profile) for profile in profiles])


def _mix(profile: str, counts: str, targets: str) -> str:
    return MIX.format(
        profile=profile, counts=counts, targets=re.sub(r", (0\.\d+)\)", r", CAST(\1 AS DOUBLE))", targets)
    )


LENGTHS = {
    "product_category_name_translation": {"product_category_name": 64, "product_category_name_english": 64},
    "geolocation": {"geolocation_city": 64, "geolocation_state": 64},
    "sellers": {"seller_id": 64, "seller_city": 64, "seller_state": 64},
    "customers": {"customer_id": 64, "customer_unique_id": 32, "customer_city": 64, "customer_state": 64},
    "products": {"product_id": 64, "product_category_name": 64},
    "orders": {"order_id": 64, "customer_id": 64, "order_status": 32},
    "order_items": {"order_id": 64, "product_id": 64, "seller_id": 64},
    "payments": {"order_id": 64, "payment_type": 32},
    "order_reviews": {"review_id": 64, "order_id": 64, "review_comment_message": 300},
}

MILESTONES = {
    "created without later milestones": """order_status = 'created' AND coalesce(order_approved_at,
        order_delivered_carrier_date, order_delivered_customer_date) IS NOT NULL""",
    "approved at once past approval": """order_status NOT IN ('created', 'canceled') AND order_approved_at IS NULL""",
    "handed over once shipped": "order_status IN ('shipped', 'delivered') AND order_delivered_carrier_date IS NULL",
    "received once delivered": "order_status = 'delivered' AND order_delivered_customer_date IS NULL",
    "approval after purchase": "order_approved_at < order_purchase_timestamp",
    "hand-over after approval": "order_delivered_carrier_date < order_approved_at",
    "receipt after hand-over": "order_delivered_customer_date < order_delivered_carrier_date",
}

# One step per event along the life cycle, event by event.
TRANSITIONS = f"""-- recursive
WITH numbered AS (
    SELECT CAST(key AS VARCHAR) AS order_id, event_time AS moment, op = 'd' AS cancel,
           row_number() OVER (PARTITION BY key ORDER BY lsn) AS step FROM changes),
history AS (
    SELECT 0 AS step, {ALL_ORDERS} FROM orders_v
    UNION ALL
    SELECT n.step, h.order_id, customer_id, s.status, order_purchase_timestamp,
           CASE WHEN s.status = 'approved' AND s.status <> order_status THEN moment ELSE order_approved_at END,
           CASE WHEN s.status = 'shipped' AND s.status <> order_status THEN moment ELSE order_delivered_carrier_date END,
           CASE WHEN s.status = 'delivered' AND s.status <> order_status THEN moment ELSE order_delivered_customer_date END,
           order_estimated_delivery_date
    FROM history h JOIN numbered n ON n.order_id = h.order_id AND n.step = h.step + 1,
         LATERAL (SELECT CASE
             WHEN cancel AND order_status NOT IN ('shipped', 'delivered') THEN 'canceled'
             WHEN order_status = 'created' THEN 'approved' WHEN order_status = 'approved' THEN 'processing'
             WHEN order_status = 'processing' THEN 'invoiced' WHEN order_status = 'invoiced' THEN 'shipped'
             WHEN order_status = 'shipped' THEN 'delivered' ELSE order_status END AS status) s)
SELECT {ALL_ORDERS} FROM history QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY step DESC) = 1"""

# Fields of the log whose shape changes on three days.
DRIFTING = """SELECT dt, op, lsn, CASE WHEN dt < DATE '2024-01-21' THEN CAST(key AS VARCHAR) ELSE 'k' || key END AS key,
        CASE WHEN dt >= DATE '2024-01-11' THEN status END AS status,
        CASE WHEN dt < DATE '2024-01-11' THEN lsn % 100 WHEN dt < DATE '2024-01-26' THEN lsn % 100 + 0.5::DOUBLE END AS value
    FROM changes"""

DRIFT = f"""
WITH days AS (SELECT dt, row_number() OVER (ORDER BY dt) AS n FROM (SELECT DISTINCT dt FROM changes)),
typed AS (
    SELECT n, 'key' AS field, CASE WHEN dt < DATE '2024-01-21' THEN 'bigint' ELSE 'string' END AS type FROM days
    UNION ALL SELECT n, 'status', 'string' FROM days WHERE dt >= DATE '2024-01-11'
    UNION ALL SELECT n, 'value', CASE WHEN dt < DATE '2024-01-11' THEN 'bigint' ELSE 'double' END FROM days
    WHERE dt < DATE '2024-01-26')
SELECT CAST(d.dt AS VARCHAR) AS dt, field, change, previous_type, type
FROM (SELECT coalesce(t.n, p.n + 1) AS n, coalesce(t.field, p.field) AS field, p.type AS previous_type, t.type AS type,
             CASE WHEN p.n IS NULL THEN 'added' WHEN t.n IS NULL THEN 'lost'
                  WHEN p.type = 'bigint' AND t.type = 'double' THEN 'widened' ELSE 'changed' END AS change
      FROM typed t FULL JOIN typed p ON t.field = p.field AND t.n = p.n + 1) c
JOIN days d ON d.n = c.n
WHERE previous_type IS DISTINCT FROM type"""


def _determinant(a: str, b: str, c: str) -> str:
    """Of a matrix of three columns, each a list in SQL."""
    return (
        f"({a}[1] * ({b}[2] * {c}[3] - {b}[3] * {c}[2]) - {b}[1] * ({a}[2] * {c}[3] - {a}[3] * {c}[2])"
        f" + {c}[1] * ({a}[2] * {b}[3] - {a}[3] * {b}[2]))"
    )


# Normal equations of three features about their means, solved by Cramer's rule.
HELD_OUT = f"""
WITH features AS (
    SELECT CAST(o.order_id AS BIGINT) % 5 = 0 AS held_out, coalesce(CAST(items AS DOUBLE), 0) AS p,
           coalesce(CAST(price AS DOUBLE), 0) AS q,
           coalesce(CAST({hours('order_purchase_timestamp', 'order_approved_at')} AS DOUBLE), 0) AS r,
           CAST({hours('order_purchase_timestamp', 'order_delivered_customer_date')} AS DOUBLE) AS y
    FROM orders_v o LEFT JOIN ({TOTALS}) t ON o.order_id = t.order_id),
sums AS (
    SELECT avg(p) AS mp, avg(q) AS mq, avg(r) AS mr, avg(y) AS my,
           [var_pop(p), covar_pop(p, q), covar_pop(p, r)] AS cp, [covar_pop(p, q), var_pop(q), covar_pop(q, r)] AS cq,
           [covar_pop(p, r), covar_pop(q, r), var_pop(r)] AS cr, [covar_pop(p, y), covar_pop(q, y), covar_pop(r, y)] AS cy
    FROM features WHERE NOT held_out AND y IS NOT NULL),
weights AS (
    SELECT *, {_determinant('cy', 'cq', 'cr')} / {_determinant('cp', 'cq', 'cr')} AS wp,
           {_determinant('cp', 'cy', 'cr')} / {_determinant('cp', 'cq', 'cr')} AS wq,
           {_determinant('cp', 'cq', 'cy')} / {_determinant('cp', 'cq', 'cr')} AS wr FROM sums),
errors AS (
    SELECT my + wp * (p - mp) + wq * (q - mq) + wr * (r - mr) - y AS e, y FROM features, weights
    WHERE held_out AND y IS NOT NULL)
SELECT count(*) AS n, round(avg(e), 5) AS mean_error, round(sqrt(avg(e * e)), 5) AS rmse,
       round(1 - avg(e * e) / var_pop(y), 5) AS r2 FROM errors"""

_ORACLES = {
    "o01_load_csv": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_shipdate AS shipping_limit_date, l_extendedprice AS price, l_tax AS freight_value
        FROM lineitem""",
    "o02_schema_catalog": f"SELECT {FULL_PRODUCTS.format(category='product_category_name')} FROM products",
    "o03_list_tables": "SELECT name, rows FROM tables_v",
    "o04_snapshot_as_of": ACCOUNTS_AFTER.format("lsn <= (SELECT middle FROM bound)"),
    "o05_write_snapshot": f"SELECT {ALL_ORDERS} FROM orders_v",
    "o06_snapshot_table_inferred": """
        SELECT CAST(s_suppkey AS INT) AS seller_id, s_nationkey AS seller_zip_code_prefix, n_name AS seller_city,
               r_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "o07_snapshot_tables": "SELECT name, rows FROM tables_v",
    "o08_quoted_csv": "SELECT CAST(doc_id AS VARCHAR) AS review_id, text AS review_comment_message FROM documents",
    "o09_read_changes": f"SELECT {IMAGE}, CAST(dt AS VARCHAR) AS dt FROM changes",
    "o09_changes_table": f"SELECT {IMAGE}, CAST(dt AS VARCHAR) AS dt FROM changes",
    "o09_schema_drift": DRIFT,
    "o09_drifted_changes": f"SELECT CAST(dt AS VARCHAR) AS dt, op, lsn, key, status, value FROM ({DRIFTING})",
    "o10_partition_discovery": f"""
        SELECT CAST(dt AS VARCHAR) AS dt, count(*) AS events, CAST(sum(lsn) AS BIGINT) AS sum_lsn, {PAYLOAD}
        FROM changes GROUP BY dt""",
    "o10_epoch_partitions": f"""
        SELECT CASE WHEN dt < DATE '2024-01-16' THEN 1 ELSE 2 END AS epoch, CAST(dt AS VARCHAR) AS dt, lsn, key, op, status
        FROM (SELECT {IMAGE}, dt FROM changes)""",
    "o11_change_log_sink": f"""
        SELECT "table", CAST(dt AS VARCHAR) AS dt, count(*) AS events, CAST(sum(lsn) AS BIGINT) AS sum_lsn,
               {PAYLOAD}
        FROM ({ROUTED}) WHERE "table" <> 'geolocation' GROUP BY "table", dt""",
    "o11_rolled_log": f"""
        SELECT "table", CAST(dt AS VARCHAR) AS dt, file, count(*) AS events, min(lsn) AS first_lsn, max(lsn) AS last_lsn,
               true AS within_bytes, {PAYLOAD}
        FROM (SELECT *, (row_number() OVER (PARTITION BY "table", dt ORDER BY lsn) - 1) // 1000 AS file FROM ({ROUTED}))
        WHERE "table" <> 'geolocation' GROUP BY "table", dt, file""",
    "o12_route_changes": f"""
        SELECT 'shop.public.' || "table" AS topic, lsn, op FROM ({ROUTED}) WHERE "table" <> 'geolocation'""",
    "o13_snapshot_diff": f"""
        SELECT coalesce(o.key, n.key) AS key,
               CASE WHEN o.key IS NULL THEN 'c' WHEN n.key IS NULL THEN 'd' ELSE 'u' END AS op,
               o.status AS before_status, o.value AS before_value, n.status AS after_status, n.value AS after_value
        FROM ({ACCOUNTS_AFTER.format("lsn <= (SELECT middle FROM bound)")}) o
        FULL JOIN ({ACCOUNTS_AFTER.format("true")}) n ON o.key = n.key
        WHERE o.key IS NULL OR n.key IS NULL OR o.status IS DISTINCT FROM n.status OR o.value IS DISTINCT FROM n.value""",
    "o13_keyless_diff": """
        WITH lines AS (
            SELECT CAST(order_id AS BIGINT) AS id, seller_id, order_item_id, price > 20000 AS dear FROM order_items),
        old AS (SELECT * EXCLUDE (id) FROM lines WHERE id % 7 <> 0),
        new AS (SELECT * EXCLUDE (id) FROM lines WHERE id % 5 <> 0)
        SELECT 'c' AS op, * FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old)
        UNION ALL
        SELECT 'd' AS op, * FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new)""",
    "o14_missing_changes": "SELECT * FROM sellers",
    "o15_cdc_tables": """
        SELECT name, rows FROM tables_v
        WHERE name IN ('customers', 'orders', 'order_items', 'sellers', 'payments', 'order_reviews')""",
    "o16_materialize": DIM_PLACE.format(
        columns="customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state",
        table="customers", zip="customer_zip_code_prefix"),
    "o17_append_rows": f"SELECT {ALL_ORDERS} FROM orders_v",
    "o18_decode_changes": f"""
        SELECT lsn, key, op, status, CAST(epoch_us(image.event_time) AS VARCHAR) AS event_time, value, ts_ms,
               'orders' AS "table", CAST(dt AS VARCHAR) AS dt
        FROM (SELECT {IMAGE}, epoch_us(c.event_time) // 1000 AS ts_ms, dt FROM changes c) image""",
    "o18_unreadable_events": f"""
        SELECT lsn, CASE WHEN good THEN key END AS key, CASE WHEN good THEN op END AS op,
               CASE WHEN good THEN status END AS status, good AS readable, CAST(dt AS VARCHAR) AS dt
        FROM (SELECT {IMAGE}, lsn % 7 <> 0 AND lsn % 11 <> 0 AS good, dt FROM changes)""",
    "o19_normalize": """
        SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
               order_delivered_carrier_date, CAST(NULL AS TIMESTAMP) AS order_delivered_customer_date,
               order_estimated_delivery_date
        FROM orders_v""",
    "o20_dedupe_changes": """
        SELECT lsn, key, event_time, CAST(min(dt) AS VARCHAR) AS dt, op, status, value, "table"
        FROM (SELECT *, 'orders' AS "table" FROM changes
              UNION ALL SELECT * REPLACE (CAST(dt + INTERVAL 1 DAY AS DATE) AS dt), 'orders' FROM changes)
        GROUP BY ALL""",
    "o21_unify": """
        SELECT key, status, value, 'r' AS op, CAST(-1 AS BIGINT) AS lsn, CAST(NULL AS TIMESTAMP) AS event_time FROM accounts
        UNION ALL SELECT key, status, value, op, lsn, event_time FROM changes""",
    "o22_latest_state": f"SELECT * FROM ({LATEST}) WHERE op <> 'd'",
    "o22_current_state": ACCOUNTS_AFTER.format("true"),
    "o23_after_bookmark": """
        SELECT a.key, a.status, a.value FROM accounts a
        WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE c.key = a.key AND c.dt >= DATE '2024-01-16')
        UNION ALL
        SELECT key, status, value FROM (
            SELECT * FROM changes WHERE dt >= DATE '2024-01-16'
            QUALIFY row_number() OVER (PARTITION BY key ORDER BY lsn DESC) = 1) WHERE op <> 'd'""",
    "o23_epoch_tables": """
        SELECT 'orders' AS "table", o.order_id, o.order_status AS status, CAST(NULL AS DOUBLE) AS value FROM orders_v o
        WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE CAST(c.key AS VARCHAR) = o.order_id AND c.dt >= DATE '2024-01-16')
        UNION ALL
        SELECT 'orders', CAST(key AS VARCHAR), status, NULL FROM (
            SELECT * FROM changes WHERE dt >= DATE '2024-01-16'
            QUALIFY row_number() OVER (PARTITION BY key ORDER BY lsn DESC) = 1) WHERE op <> 'd'
        UNION ALL
        SELECT 'payments', order_id, payment_type, payment_value FROM payments
        UNION ALL
        SELECT 'payments', CAST(key AS VARCHAR), 'credit_card', CAST(floor(value) AS DOUBLE) FROM changes
        WHERE dt >= DATE '2024-01-16'""",
    "o24_append_only_state": """
        SELECT * FROM payments
        UNION ALL
        SELECT CAST(key AS VARCHAR), 1, 'credit_card', 1, CAST(floor(value) AS DOUBLE) FROM changes""",
    "o24_append_stream": "SELECT lsn, key, 'c' AS op, status, event_time, value FROM changes",
    "o25_geolocation_unique": "SELECT * FROM places",
    "o26_translate_category": """
        SELECT p.* REPLACE (coalesce(product_category_name_english, p.product_category_name) AS product_category_name)
        FROM products p LEFT JOIN product_category_name_translation t ON p.product_category_name = t.product_category_name""",
    "o27_merge_batch": f"SELECT * FROM ({LATEST}) WHERE op <> 'd'",
    "o27_merge_buckets": f"SELECT * FROM ({LATEST}) WHERE op <> 'd'",
    "o28_apply_transition": TRANSITIONS,
    "o29_select_all": "SELECT * FROM customers",
    "o30_select_columns": "SELECT geolocation_zip_code_prefix, geolocation_city, geolocation_state FROM geolocation",
    "o31_lookup": "SELECT order_id, order_item_id, price FROM order_items WHERE product_id = '7'",
    "o32_open_orders": "SELECT order_id, order_status FROM orders_v WHERE order_status NOT IN ('delivered', 'canceled')",
    "o33_sample_rows": """
        SELECT * FROM customers WHERE substr(md5('7:' || customer_id), 1, 8) < '0ccccccc'""",
    "o33_sample_blocks": f"""
        SELECT {IMAGE}, CAST(dt AS VARCHAR) AS dt FROM changes
        WHERE substr(md5('7:dt=' || CAST(dt AS VARCHAR)), 1, 8) < '66666666'""",
    "o34_random_top": """
        SELECT order_id, order_status FROM orders_v WHERE order_status NOT IN ('delivered', 'canceled')
        ORDER BY md5('7:' || order_id), order_id LIMIT 100""",
    "o35_first_rows": """
        SELECT order_id, order_item_id, product_id, seller_id, price, freight_value FROM order_items
        ORDER BY price DESC, order_id, order_item_id, product_id, seller_id, freight_value LIMIT 100""",
    "o36_price_or_default": """
        SELECT p.product_id, coalesce(price, 100.0) AS price
        FROM products p LEFT JOIN (
            SELECT product_id, price FROM order_items
            QUALIFY row_number() OVER (PARTITION BY product_id
                ORDER BY shipping_limit_date DESC, order_id DESC, order_item_id DESC, price DESC) = 1) i
          ON p.product_id = i.product_id""",
    "o36_price_as_of": """
        WITH i AS (SELECT row_number() OVER () AS r, * FROM order_items)
        SELECT a.order_id, a.order_item_id, a.product_id, a.shipping_limit_date AS at, coalesce(b.price, 100.0) AS price
        FROM i a LEFT JOIN i b ON a.product_id = b.product_id AND b.shipping_limit_date < a.shipping_limit_date
        QUALIFY row_number() OVER (PARTITION BY a.r
            ORDER BY b.shipping_limit_date DESC NULLS LAST, b.order_id DESC, b.order_item_id DESC, b.price DESC) = 1""",
    "o36_place_or_default": """
        SELECT customer_id, customer_zip_code_prefix,
               coalesce(geolocation_zip_code_prefix, 10000) AS place_zip,
               coalesce(geolocation_city, 'Sao Paulo') AS place_city,
               coalesce(geolocation_state, 'SP') AS place_state
        FROM (SELECT customer_id, CAST(customer_zip_code_prefix + 10 AS INT) AS customer_zip_code_prefix FROM customers)
        LEFT JOIN places ON customer_zip_code_prefix = geolocation_zip_code_prefix""",
    "o37_dim_customers": DIM_PLACE.format(
        columns="customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state",
        table="customers", zip="customer_zip_code_prefix"),
    "o37_dim_products": f"""
        SELECT {FULL_PRODUCTS.format(category='coalesce(product_category_name_english, p.product_category_name)')}
        FROM products p LEFT JOIN product_category_name_translation t ON p.product_category_name = t.product_category_name""",
    "o37_dim_sellers": DIM_PLACE.format(
        columns="seller_id, seller_zip_code_prefix, seller_city, seller_state",
        table="sellers", zip="seller_zip_code_prefix"),
    "o38_dim_date": f"""
        SELECT {date_key('d')} AS date_key, strftime(d, '%Y-%m-%d') AS date, CAST(year(d) AS INT) AS year,
               CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day,
               CAST(week(d) AS INT) AS iso_week, CAST(isodow(d) AS INT) AS weekday, isodow(d) >= 6 AS is_weekend
        FROM (SELECT unnest(generate_series(first, last, INTERVAL 1 DAY)) AS d FROM (
            SELECT min(o_orderdate) AS first, max(o_orderdate) + CASE WHEN bool_or(late) THEN INTERVAL 9 DAY
                   ELSE INTERVAL 8 DAY END AS last
            FROM (SELECT o_orderdate, o_orderstatus = 'F' AND o_orderkey % 3 = 0
                         AND o_orderdate = max(o_orderdate) OVER () AS late FROM orders)))""",
    "o39_fact_orders": f"""
        SELECT order_id, o.customer_id, customer_unique_id, order_status,
               {date_key('order_purchase_timestamp')} AS purchase_date_key,
               {date_key('order_approved_at')} AS approved_date_key,
               {date_key('order_delivered_carrier_date')} AS carrier_date_key,
               {date_key('order_delivered_customer_date')} AS delivered_date_key,
               {date_key('order_estimated_delivery_date')} AS estimated_date_key,
               order_delivered_customer_date > order_estimated_delivery_date AS is_late
        FROM orders_v o LEFT JOIN customers c ON o.customer_id = c.customer_id""",
    "o39_fact_order_items": f"""
        SELECT i.order_id, order_item_id, product_id, seller_id, o.customer_id, customer_unique_id, order_status,
               {date_key('order_purchase_timestamp')} AS purchase_date_key,
               {date_key('shipping_limit_date')} AS shipping_limit_date_key,
               CAST(CAST(price AS DECIMAL(18,2)) AS DOUBLE) AS price,
               CAST(CAST(freight_value AS DECIMAL(18,2)) AS DOUBLE) AS freight,
               CAST(CAST(price AS DECIMAL(18,2)) + CAST(freight_value AS DECIMAL(18,2)) AS DOUBLE) AS price_and_freight
        FROM order_items i LEFT JOIN orders_v o ON i.order_id = o.order_id
        LEFT JOIN customers c ON o.customer_id = c.customer_id""",
    "o39_fact_payments": f"""
        SELECT p.order_id, payment_sequential, payment_type, payment_installments, customer_id,
               {date_key('order_purchase_timestamp')} AS purchase_date_key,
               CAST(CAST(payment_value AS DECIMAL(18,2)) AS DOUBLE) AS payment_value
        FROM payments p LEFT JOIN orders_v o ON p.order_id = o.order_id""",
    "o39_fact_reviews": f"""
        SELECT review_id, r.order_id, customer_id, {date_key('order_purchase_timestamp')} AS purchase_date_key,
               {date_key('review_creation_date')} AS review_date_key, review_score,
               CAST(length(review_comment_message) AS INT) AS message_length,
               {hours('review_creation_date', 'review_answer_timestamp')} AS hours_to_answer
        FROM order_reviews r LEFT JOIN orders_v o ON r.order_id = o.order_id""",
    "o40_order_totals": f"""
        SELECT order_id, items, CAST(price AS DOUBLE) AS price, CAST(freight AS DOUBLE) AS freight,
               CAST(price + freight AS DOUBLE) AS total
        FROM ({TOTALS})""",
    "o40_reconcile_payments": f"""
        SELECT p.order_id, coalesce(items, 0) AS items, CAST(price + freight AS DOUBLE) AS total,
               CAST(paid AS DOUBLE) AS paid,
               CASE WHEN items IS NULL THEN 'no items' WHEN abs(paid - price - freight) <= 0.01 THEN 'match'
                    ELSE 'mismatch' END AS outcome
        FROM (SELECT order_id, sum(CAST(payment_value AS DECIMAL(18,2))) AS paid FROM payments GROUP BY order_id) p
        LEFT JOIN ({TOTALS}) t ON p.order_id = t.order_id""",
    "o41_check_unique": union([
        unique_rule("product_category_name_translation", "product_category_name"),
        unique_rule("sellers", "seller_id"),
        unique_rule("customers", "customer_id"),
        unique_rule("products", "product_id"),
        unique_rule("orders", "order_id", "orders_v"),
        unique_rule("order_items", "order_id, order_item_id"),
    ]),
    "o42_check_required": union([
        *row_rules("product_category_name_translation", {"required product_category_name": "product_category_name IS NULL"}),
        *row_rules("sellers", {"required seller_id": "seller_id IS NULL"}),
        *row_rules("customers", {"required customer_id": "customer_id IS NULL"}),
        *row_rules("products", {"required product_id": "product_id IS NULL",
                                "required product_category_name": "product_category_name IS NULL"}),
        *row_rules("orders", {"required order_id": "order_id IS NULL"}, "orders_v"),
    ]),
    "o43_check_fk": union([
        fk_rule("products", "product_category_name", "product_category_name_translation", "product_category_name"),
        fk_rule("orders", "customer_id", "customers", "customer_id", child_source="orders_v"),
        fk_rule("order_items", "product_id", "products", "product_id"),
        fk_rule("order_items", "order_id", "orders", "order_id", parent_source="orders_v"),
        fk_rule("order_items", "seller_id", "sellers", "seller_id"),
        fk_rule("payments", "order_id", "orders", "order_id", parent_source="orders_v"),
        fk_rule("order_reviews", "order_id", "orders", "order_id", parent_source="orders_v"),
    ]),
    "o44_check_length": union([
        part
        for table, limits in LENGTHS.items()
        for part in row_rules(
            table,
            {f"length {c} <= {n}": f"length({c}) > {n}" for c, n in limits.items()},
            "orders_v" if table == "orders" else None,
        )
    ]),
    "o45_validate_table": """
        SELECT name AS "table", rule, CASE rule WHEN 'not empty' THEN rows ELSE 1 END AS checked,
               CASE WHEN rule = 'not empty' AND rows = 0 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS failed
        FROM tables_v, (VALUES ('present'), ('schema'), ('not empty')) AS r(rule)
        UNION ALL SELECT 'wrong schema', 'present', 1, 0
        UNION ALL SELECT 'wrong schema', 'schema', 1, 1
        UNION ALL SELECT 'wrong schema', 'not empty', count(*), 0 FROM orders_v
        UNION ALL SELECT 'absent', 'present', 1, 1
        UNION ALL SELECT 'absent', 'schema', 0, 0
        UNION ALL SELECT 'absent', 'not empty', 0, 0""",
    "o46_illegal_transitions": """
        SELECT key, lsn, previous_status, status, previous_status IS NULL AS is_first
        FROM (SELECT key, lsn, status, lag(status) OVER (PARTITION BY key ORDER BY lsn) AS previous_status FROM changes)
        WHERE coalesce(previous_status, '-') || '>' || status NOT IN (
            '->created', 'created>approved', 'approved>processing', 'processing>invoiced', 'invoiced>shipped',
            'shipped>delivered', 'created>canceled', 'approved>canceled', 'processing>canceled', 'invoiced>canceled')""",
    "o46_illegal_steps_stream": """
        SELECT key, lsn, previous_status, status, previous_status IS NULL AS is_first
        FROM (SELECT key, lsn, op, status,
                     lag(CASE WHEN op <> 'd' THEN status END) OVER (PARTITION BY key ORDER BY lsn) AS previous_status FROM changes)
        WHERE op <> 'd' AND coalesce(previous_status, '-') || '>' || status NOT IN (
            '->created', 'created>approved', 'approved>processing', 'processing>invoiced', 'invoiced>shipped',
            'shipped>delivered', 'created>canceled', 'approved>canceled', 'processing>canceled', 'invoiced>canceled')""",
    "o47_check_milestones": union(row_rules("orders", MILESTONES, "orders_v")),
    "o47_check_write_rules": union([
        *row_rules("payments", {
            "one payment per order": "payment_sequential <> 1",
            "1 to 10 instalments by card": "payment_type = 'credit_card' AND payment_installments NOT BETWEEN 1 AND 10",
            "one instalment otherwise": "payment_type <> 'credit_card' AND payment_installments <> 1"}),
        *row_rules("order_items", {
            "price from 10 to 300": "price NOT BETWEEN 10 AND 300",
            "freight from 5 to 50": "freight_value NOT BETWEEN 5 AND 50"}),
        *row_rules("order_reviews", {"answer not before creation": "review_answer_timestamp < review_creation_date"}),
        *row_rules("orders", {"estimate 10 to 20 days after purchase": """
            order_estimated_delivery_date NOT BETWEEN order_purchase_timestamp + INTERVAL 10 DAY
            AND order_purchase_timestamp + INTERVAL 20 DAY"""}, "orders_v"),
        *row_rules("order_reviews", {
            "reviewed once delivered": "order_status <> 'delivered'",
            "review after receipt": "review_creation_date < order_delivered_customer_date"}, "(SELECT * FROM order_reviews r JOIN orders_v o ON r.order_id = o.order_id)"),
        *row_rules("order_items", {"shipping limit 5 days after purchase":
            "shipping_limit_date <> order_purchase_timestamp + INTERVAL 5 DAY"},
            "(SELECT * FROM order_items i JOIN orders_v o ON i.order_id = o.order_id)"),
        *row_rules("products", {"one price per product": "low <> high"},
            "(SELECT min(price) AS low, max(price) AS high FROM order_items GROUP BY product_id)"),
        *row_rules("customers", {"returning buyers keep their place": "zips > 1 OR cities > 1 OR states > 1"},
            """(SELECT count(DISTINCT customer_zip_code_prefix) AS zips, count(DISTINCT customer_city) AS cities,
                       count(DISTINCT customer_state) AS states FROM customers GROUP BY customer_unique_id)"""),
    ]),
    "o48_check_item_sequence": rule(
        "order_items", "item numbers contiguous",
        "count(*) FILTER (NOT sound)",
        source="""(SELECT list_sort(list(order_item_id)) = range(1, count(*) + 1) AS sound
                   FROM order_items GROUP BY order_id)"""),
    "o49_mix_profile": mixes(),
    "o49_cancel_mix": "SELECT value, n, share, target FROM (" + _mix(
        "cancel", """SELECT CAST(status = 'canceled' AS VARCHAR) AS value, count(*) AS n FROM (
            SELECT status, lag(status) OVER (PARTITION BY key ORDER BY lsn) AS previous FROM changes)
            WHERE previous IN ('created', 'approved', 'processing', 'invoiced') AND status <> previous GROUP BY 1""",
        "('true', 0.05), ('false', 0.95)") + ")",
    "o50_order_durations": f"""
        SELECT order_id, {hours('order_purchase_timestamp', 'order_approved_at')} AS hours_to_approval,
               {hours('order_approved_at', 'order_delivered_carrier_date')} AS hours_to_carrier,
               {hours('order_delivered_carrier_date', 'order_delivered_customer_date')} AS hours_to_customer,
               {hours('order_purchase_timestamp', 'order_delivered_customer_date')} AS hours_total,
               {hours('order_estimated_delivery_date', 'order_delivered_customer_date')} AS hours_past_estimate,
               order_delivered_customer_date > order_estimated_delivery_date AS is_late
        FROM orders_v""",
    "o51_change_stream": f"SELECT {IMAGE}, CAST(dt AS VARCHAR) AS dt FROM changes",
    "o52_resume": "SELECT lsn, key, op, CAST(dt AS VARCHAR) AS dt FROM changes",
    "o53_micro_batches": f"""
        SELECT op, count(*) AS events, CAST(sum(lsn) AS BIGINT) AS sum_lsn, {PAYLOAD} FROM changes GROUP BY op""",
    "o54_dedupe_stream": f"SELECT lsn, key, op, status, value FROM (SELECT {IMAGE} FROM changes)",
    "o55_upsert_stream": f"SELECT * FROM ({LATEST}) WHERE op <> 'd'",
    "o55_keyed_stream": f"SELECT * FROM ({LATEST}) WHERE op <> 'd'",
    "o55_upsert_restart": f"SELECT * FROM ({LATEST}) WHERE op <> 'd'",
    "o56_late_data": f"SELECT * FROM ({LATEST}) WHERE op <> 'd'",
    "o56_lateness": """
        SELECT CAST(day AS VARCHAR) AS dt, count(*) AS events, count(*) FILTER (late > 0) AS late, 0::BIGINT AS untimed,
               max(late) AS longest, true AS within_50, true AS within_90, true AS within_99
        FROM (SELECT day, greatest(0, CAST(floor(date_diff('microsecond', event_time, CAST(day AS TIMESTAMP)) / 1e6) AS BIGINT)) AS late
              FROM (SELECT CAST(dt + CAST(lsn * lsn % 11 % 5 AS INT) AS DATE) AS day, event_time FROM changes))
        GROUP BY day""",
    "o57_order_features": f"""
        SELECT o.order_id, CAST(coalesce(items, 0) AS DOUBLE) AS items, coalesce(CAST(price AS DOUBLE), 0) AS value,
               coalesce(CAST(freight AS DOUBLE), 0) AS freight,
               coalesce(CAST({hours('order_purchase_timestamp', 'order_approved_at')} AS DOUBLE), 0) AS hours_to_approval,
               coalesce(customer_state, 'unknown') AS state,
               CAST({hours('order_purchase_timestamp', 'order_delivered_customer_date')} AS DOUBLE) AS delivery_hours
        FROM orders_v o LEFT JOIN ({TOTALS}) t ON o.order_id = t.order_id
        LEFT JOIN customers c ON o.customer_id = c.customer_id""",
    "o57_held_out_error": HELD_OUT,
    "o57_value_trend": f"""
        SELECT round(regr_slope(y, x), 8) AS slope, round(regr_intercept(y, x), 5) AS intercept
        FROM (SELECT coalesce(CAST(price AS DOUBLE), 0) AS x,
                     CAST({hours('order_purchase_timestamp', 'order_delivered_customer_date')} AS DOUBLE) AS y
              FROM orders_v o LEFT JOIN ({TOTALS}) t ON o.order_id = t.order_id) WHERE y IS NOT NULL""",
}

ORACLES = {name: with_shapes(sql) for name, sql in _ORACLES.items()}
