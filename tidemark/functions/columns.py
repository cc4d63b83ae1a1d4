from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import CANCELED, STATUS_CHAIN

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(amount: Column | str) -> Column:
    """Amount in whole cents as bigint, rounded as a decimal: 1.005 is 101.

    Sums of cents do not depend on row order, and long arithmetic keeps the
    aggregate in generated code, which decimals over 18 digits do not.
    """
    return (_col(amount).cast("decimal(16,2)") * 100).cast("bigint")


def money(whole_cents: Column | str) -> Column:
    """Whole cents as decimal(22,2), which holds any bigint."""
    return _col(whole_cents).cast("decimal(19,0)") * F.lit("0.01").cast("decimal(2,2)")


def price(amount: Column | str) -> Column:
    """A single amount as decimal(18,2), a decimal that fits one machine word."""
    return cents(amount).cast("decimal(15,0)") * F.lit("0.01").cast("decimal(2,2)")


def timestamp_of_micros(micros: Column | str) -> Column:
    """Zone-less timestamp from microseconds since 1970, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", _col(micros), F.expr(_EPOCH))


def micros_of(ts: Column | str) -> Column:
    """Microseconds since 1970 of a zone-less timestamp.

    Built from calendar fields: timestamp_diff would first read the value in
    the session zone.
    """
    ts = _col(ts)
    minutes = (F.unix_date(ts.cast("date")).cast("bigint") * 24 + F.hour(ts)) * 60 + F.minute(ts)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def as_timestamp(text: Column | str) -> Column:
    """Zone-less timestamp from a string of integer microseconds or ISO text."""
    text = _col(text)
    micros = text.try_cast("bigint")
    return F.when(micros.isNotNull(), timestamp_of_micros(micros)).otherwise(text.try_cast("timestamp_ntz"))


def date_key(ts: Column | str) -> Column:
    """Integer yyyymmdd, the key of the date dimension."""
    ts = _col(ts)
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def elapsed_hours(start: Column | str, end: Column | str) -> Column:
    """Whole hours from start to end; null if either is missing."""
    return F.floor((micros_of(end) - micros_of(start)) / 3_600_000_000)


def hex_uuid() -> Column:
    """Random 32-digit identifier."""
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))


def next_status(status: Column | str, cancel: Column | bool = False) -> Column:
    """Status after one step: one place along the chain, or canceled before shipping.

    Closed and unknown statuses stay as they are, except that an unknown one
    can be canceled like any status before shipping.
    """
    status = _col(status)
    cancel = cancel if isinstance(cancel, Column) else F.lit(cancel)
    locked = status.isin("shipped", "delivered", CANCELED)
    moved = F.when(cancel & ~locked, F.lit(CANCELED))
    for here, there in zip(STATUS_CHAIN, STATUS_CHAIN[1:]):
        moved = moved.when(status == here, F.lit(there))
    return moved.otherwise(status)
