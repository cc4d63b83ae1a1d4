"""Column expressions, all evaluated inside the JVM."""

from tidemark.functions.columns import (
    as_timestamp,
    cents,
    date_key,
    elapsed_hours,
    hex_uuid,
    micros_of,
    money,
    next_status,
    price,
    timestamp_of_micros,
)

__all__ = [
    "as_timestamp",
    "cents",
    "date_key",
    "elapsed_hours",
    "hex_uuid",
    "micros_of",
    "money",
    "next_status",
    "price",
    "timestamp_of_micros",
]
