"""Fixed schemas, keys and rules of the nine retail tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Table layouts, keys, limits and vocabularies of the source
# system. They must equal the source's for results to be right.
# ---------------------------------------------------------------------------

COLUMNS = {
    "product_category_name_translation": """
        product_category_name string required
        product_category_name_english string
    """,
    "geolocation": """
        geolocation_zip_code_prefix int
        geolocation_lat double
        geolocation_lng double
        geolocation_city string
        geolocation_state string
    """,
    "sellers": """
        seller_id string required
        seller_zip_code_prefix int
        seller_city string
        seller_state string
    """,
    "customers": """
        customer_id string required
        customer_unique_id string
        customer_zip_code_prefix int
        customer_city string
        customer_state string
    """,
    "products": """
        product_id string required
        product_category_name string
        product_name_length int
        product_description_length int
        product_photos_qty int
        product_weight_g int
        product_length_cm double
        product_height_cm double
        product_width_cm double
    """,
    "orders": """
        order_id string required
        customer_id string
        order_status string
        order_purchase_timestamp timestamp
        order_approved_at timestamp
        order_delivered_carrier_date timestamp
        order_delivered_customer_date timestamp
        order_estimated_delivery_date timestamp
    """,
    "order_items": """
        order_id string
        order_item_id int
        product_id string
        seller_id string
        shipping_limit_date timestamp
        price double
        freight_value double
    """,
    "payments": """
        order_id string
        payment_sequential int
        payment_type string
        payment_installments int
        payment_value double
    """,
    "order_reviews": """
        review_id string
        order_id string
        review_score int
        review_comment_title string
        review_comment_message string
        review_creation_date timestamp
        review_answer_timestamp timestamp
    """,
}

# Primary keys. geolocation, order_items, payments and order_reviews have none.
KEYS = {
    "product_category_name_translation": ["product_category_name"],
    "sellers": ["seller_id"],
    "customers": ["customer_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("products", "product_category_name", "product_category_name_translation", "product_category_name"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
]

# Longest allowed value per string column, in characters.
LENGTH_LIMITS = {
    "product_category_name_translation": {"product_category_name": 64, "product_category_name_english": 64},
    "geolocation": {"geolocation_city": 64, "geolocation_state": 64},
    "sellers": {"seller_id": 64, "seller_city": 64, "seller_state": 64},
    "customers": {
        "customer_id": 64,
        "customer_unique_id": 32,
        "customer_city": 64,
        "customer_state": 64,
    },
    "products": {"product_id": 64, "product_category_name": 64},
    "orders": {"order_id": 64, "customer_id": 64, "order_status": 32},
    "order_items": {"order_id": 64, "product_id": 64, "seller_id": 64},
    "payments": {"order_id": 64, "payment_type": 32},
    "order_reviews": {"review_id": 64, "order_id": 64},
}

# Tables whose changes are delivered; the others are snapshot-only.
CDC_TABLES = ["customers", "orders", "order_items", "sellers", "payments", "order_reviews"]

# Order life cycle; an order may be canceled from any status before "shipped".
STATUS_CHAIN = ["created", "approved", "processing", "invoiced", "shipped", "delivered"]
CANCELED = "canceled"
CLOSED_STATUSES = ["delivered", "canceled"]

# Target weights of the generated values.
PAYMENT_TYPE_WEIGHTS = {"credit_card": 74, "boleto": 19, "voucher": 5.5, "debit_card": 1.5}
ITEMS_PER_ORDER_WEIGHTS = {1: 80, 2: 15, 3: 5}
REVIEW_SCORE_WEIGHTS = {5: 50, 4: 20, 3: 10, 2: 10, 1: 10}
RETURNING_BUYER_WEIGHTS = {True: 85, False: 15}
REVIEWED_WEIGHTS = {True: 40, False: 60}
REVIEW_TITLE_WEIGHTS = {True: 50, False: 50}
REVIEW_TEXT_WEIGHTS = {True: 70, False: 30}
CANCEL_WEIGHTS = {True: 5, False: 95}

# Place used when a zip code is unknown: zip prefix, city, state.
DEFAULT_PLACE = (10000, "Sao Paulo", "SP")

# ------------------------------ end of fixed values ------------------------

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampNTZType(),
}


def _parse(text: str) -> T.StructType:
    fields = []
    for line in text.split("\n"):
        words = line.split()
        if words:
            fields.append(T.StructField(words[0], _TYPES[words[1]], nullable="required" not in words))
    return T.StructType(fields)


SCHEMAS = {name: _parse(text) for name, text in COLUMNS.items()}


#: Columns of text that is written by rule, so no value goes over several lines:
#: ids and vocabularies, but no names of places and no comments.
ONE_LINE = frozenset(
    f.name
    for s in SCHEMAS.values()
    for f in s.fields
    if f.name.endswith("_id") or f.name in ("order_status", "payment_type")
)


def get_schema(table: str) -> T.StructType | None:
    """Fixed schema of a table; None for an unknown name."""
    return SCHEMAS.get(table)


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def allowed_transitions() -> list[tuple[str | None, str]]:
    """Legal (previous status, status) pairs; None stands for "no row yet"."""
    steps = list(zip([None, *STATUS_CHAIN], STATUS_CHAIN))
    before_shipping = STATUS_CHAIN[: STATUS_CHAIN.index("shipped")]
    return steps + [(status, CANCELED) for status in before_shipping]
