"""The given Parquet tables in the shape of the retail tables.

The bindings are part of the test set-up, not of the operators: each oracle
states the same shapes in SQL.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TRANSLATIONS = [
    ("ECONOMY", "economy"),
    ("LARGE", "large"),
    ("MEDIUM", "medium"),
    ("PROMO", "promotion"),
    ("SMALL", "small"),
]

# Schemas found in file footers, by path: looked up once per process.
_FOUND: dict[str, StructType] = {}


class Bindings:
    """Lazily bound tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        # Python workers import this package; in local mode they look where the driver does.
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _FOUND:
            _FOUND[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_FOUND[path]).parquet(path)

    def _with_places(self, df: DataFrame, nation_key: str) -> DataFrame:
        """Adds n_name and r_name."""
        places = self.raw("nation").withColumnRenamed("n_regionkey", "r_regionkey").join(self.raw("region"), "r_regionkey")
        return df.join(places.withColumnRenamed("n_nationkey", nation_key), nation_key)

    def customers(self) -> DataFrame:
        return self._with_places(self.raw("customer"), "c_nationkey").selectExpr(
            "CAST(c_custkey AS STRING) AS customer_id",
            "CAST(c_custkey % 1000 AS STRING) AS customer_unique_id",
            "c_nationkey AS customer_zip_code_prefix",
            "n_name AS customer_city",
            "r_name AS customer_state",
        )

    def sellers(self) -> DataFrame:
        return self._with_places(self.raw("supplier"), "s_nationkey").selectExpr(
            "CAST(s_suppkey AS STRING) AS seller_id",
            "s_nationkey AS seller_zip_code_prefix",
            "n_name AS seller_city",
            "r_name AS seller_state",
        )

    def geolocation(self) -> DataFrame:
        return self._with_places(self.raw("customer"), "c_nationkey").selectExpr(
            "c_nationkey AS geolocation_zip_code_prefix",
            "c_acctbal / 100 AS geolocation_lat",
            "-c_acctbal / 50 AS geolocation_lng",
            "IF(c_custkey % 3 = 0, upper(n_name), lower(n_name)) AS geolocation_city",
            "r_name AS geolocation_state",
        )

    def product_category_name_translation(self) -> DataFrame:
        return self.spark.createDataFrame(
            TRANSLATIONS, "product_category_name string, product_category_name_english string"
        )

    def products(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "CAST(p_partkey AS STRING) AS product_id",
            "IF(p_partkey % 50 = 0, NULL, p_type) AS product_category_name",
            "length(p_name) AS product_name_length",
            "p_size AS product_weight_g",
            "p_retailprice AS product_length_cm",
        )

    def orders(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "CAST(o_orderkey AS STRING) AS order_id",
            "CAST(o_custkey AS STRING) AS customer_id",
            "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'shipped' ELSE 'created' END AS order_status",
            "o_orderdate AS order_purchase_timestamp",
            "IF(o_orderstatus <> 'O' AND o_orderkey % 100 <> 7, o_orderdate + INTERVAL '6' HOUR, NULL) AS order_approved_at",
            "IF(o_orderstatus <> 'O', o_orderdate + INTERVAL '2' DAY, NULL) AS order_delivered_carrier_date",
            """CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL '9' DAY
                    WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '5' DAY END AS order_delivered_customer_date""",
            "o_orderdate + INTERVAL '8' DAY AS order_estimated_delivery_date",
        )

    def order_items(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "CAST(l_orderkey AS STRING) AS order_id",
            "l_linenumber AS order_item_id",
            "CAST(l_partkey AS STRING) AS product_id",
            "CAST(l_suppkey AS STRING) AS seller_id",
            "l_shipdate AS shipping_limit_date",
            "l_extendedprice AS price",
            "floor(l_extendedprice * l_tax * 100 + 0.5D) / 100 AS freight_value",
        )

    def payments(self) -> DataFrame:
        """One payment per order, equal to its items except for every tenth order."""
        owed = self.raw("lineitem").selectExpr(
            "l_orderkey AS o_orderkey",
            "floor(l_extendedprice * 100 + 0.5D) + floor(l_extendedprice * l_tax * 100 + 0.5D) AS cents",
        )
        owed = owed.groupBy("o_orderkey").sum("cents").withColumnRenamed("sum(cents)", "owed")
        return self.raw("orders").join(owed, "o_orderkey", "left").selectExpr(
            "CAST(o_orderkey AS STRING) AS order_id",
            "1 AS payment_sequential",
            """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'voucher' WHEN '2' THEN 'debit_card'
                    WHEN '3' THEN 'boleto' ELSE 'credit_card' END AS payment_type""",
            "1 AS payment_installments",
            "IF(owed IS NULL OR o_orderkey % 10 = 0, o_totalprice, owed / 100) AS payment_value",
        )

    def order_reviews(self) -> DataFrame:
        return self.raw("conversations").selectExpr(
            "CAST(conv_id AS STRING) AS review_id",
            "CAST(conv_id AS STRING) AS order_id",
            "1 + length(text) % 5 AS review_score",
            "CAST(NULL AS STRING) AS review_comment_title",
            "text AS review_comment_message",
            # Spread over the years of the orders; first turns are answered too early, some never.
            "TIMESTAMP_NTZ '1995-01-01 00:00:00' + make_dt_interval(CAST(conv_id * 53 % 2400 AS INT)) AS review_creation_date",
            """IF(turn % 4 = 3, NULL, TIMESTAMP_NTZ '1995-01-01 00:00:00' + make_dt_interval(
                CAST(conv_id * 53 % 2400 AS INT), CAST(turn * 7 - 3 AS INT))) AS review_answer_timestamp""",
        )

    def changes(self) -> DataFrame:
        """The events as a change log of orders: position, key, operation, status."""
        return self.raw("events").selectExpr(
            "event_id AS lsn",
            "user_id AS key",
            "ts AS event_time",
            "CAST(ts AS DATE) AS dt",
            "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op",
            """CASE event_type WHEN 'signup' THEN 'created' WHEN 'view' THEN 'approved' WHEN 'click' THEN 'processing'
                    WHEN 'purchase' THEN 'shipped' ELSE 'canceled' END AS status""",
            "value",
        )
