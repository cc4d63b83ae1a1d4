"""Change-log processing.

A flat change row holds the table's columns plus ``op`` (c, u, d or r), its
log position ``lsn`` and, as delivered, ``ts_ms``, ``table`` and ``dt``. State
kept between merges has the same form, deletes included: a deleted key must
remember its position, or a late older update would revive it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import as_timestamp, timestamp_of_micros
from tidemark.sources.change_log import UNREADABLE, is_faulty

SNAPSHOT_POSITION = -1  # before every log position


def unreadable_events(events: DataFrame) -> DataFrame:
    """Events read with ``keep_unreadable`` that ``decode_changes`` leaves out, for quarantine.

    Besides lines that do not parse, those with content but without operation.
    """
    return events.where(is_faulty(events))


def decode_changes(events: DataFrame, schema: T.StructType) -> DataFrame:
    """Flat change rows from wire events.

    Null payloads are dropped. An event with content but without operation is
    an error, unless the events were read with ``keep_unreadable``: then it and
    the lines that do not parse are left to ``unreadable_events``.

    Each column comes from the image that describes the row: ``before`` for a
    delete, else ``after``. A key missing there is taken from the other image.
    """
    columns = []
    for f in schema.fields:
        before, after = F.col(f"before.{f.name}"), F.col(f"after.{f.name}")
        if f.nullable:
            column = F.when(F.col("op") == "d", before).otherwise(after)
        else:
            column = F.coalesce(after, before)
        columns.append(column.alias(f.name))
    folders = [F.col(c) for c in ("epoch", "dt") if c in events.columns]
    faulty, has_op = is_faulty(events), F.col("op").isNotNull()
    if UNREADABLE in events.columns:
        wanted = has_op & ~faulty
    else:
        wanted = F.when(faulty, F.raise_error(F.lit("event without operation")).cast("boolean")).otherwise(has_op)
    return events.where(wanted).select(
        *columns,
        "op",
        F.col("source.lsn").alias("lsn"),
        "ts_ms",
        F.col("source.table").alias("table"),
        *folders,
    )


def normalize(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, names and types; other columns follow unchanged.

    Names match whatever their case, missing columns become nulls, timestamps
    may be microseconds or ISO text, and a value that does not fit its type
    becomes null.
    """
    given = {f.name.lower(): f for f in df.schema.fields}
    wanted = {f.name.lower() for f in schema.fields}
    columns = []
    for f in schema.fields:
        source = given.get(f.name.lower())
        if source is None:
            column = F.lit(None).cast(f.dataType)
        else:
            column = _convert(F.col(source.name), source.dataType, f.dataType)
        columns.append(column.alias(f.name))
    return df.select(*columns, *(c for c in df.columns if c.lower() not in wanted))


def misfit_rules(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """Conditions for values that ``normalize`` cannot keep, by rule name, for ``check_rows``."""
    given = {f.name.lower(): f for f in df.schema.fields}
    rules = {}
    for f in schema.fields:
        source = given.get(f.name.lower())
        if source is not None and source.dataType != f.dataType:
            value = F.col(source.name)
            rules[f"fits {f.name}"] = value.isNotNull() & _convert(value, source.dataType, f.dataType).isNull()
    return rules


def _convert(column: Column, source: T.DataType, target: T.DataType) -> Column:
    if source == target:
        return column
    if isinstance(target, T.TimestampNTZType):
        if isinstance(source, T.StringType):
            return as_timestamp(column)
        if isinstance(source, T.IntegralType):
            return timestamp_of_micros(column)
    return column.try_cast(target)


def dedupe_changes(
    changes: DataFrame,
    identity: Sequence[str] = ("table", "key", "lsn", "op"),
    delivered: str = "dt",
) -> DataFrame:
    """One row per event, the first delivered.

    Copies are reduced before the shuffle, so an event repeated very often
    does not load one task. Keyed tables need no such step before
    ``latest_state``: equal events at one position leave the same image.
    """
    # A struct is never null, so an event without delivery day is not lost; it comes last.
    order = F.struct(F.col(delivered).isNull(), F.col(delivered))
    first = changes.groupBy(*identity).agg(F.min_by(F.struct(*changes.columns), order).alias("row"))
    return first.select("row.*")


def as_state(snapshot: DataFrame) -> DataFrame:
    """Snapshot rows as state: operation ``r`` at a position before every change."""
    return snapshot.withColumns(
        {"op": F.lit("r"), "lsn": F.lit(SNAPSHOT_POSITION).cast("bigint")}
    )


def unify(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Snapshot and changes as one log."""
    return as_state(snapshot).unionByName(changes, allowMissingColumns=True)


def latest_image(log: DataFrame, keys: Sequence[str], order: str = "lsn") -> DataFrame:
    """The row with the highest position per key, deletes included.

    ``max_by`` keeps one row per key and task before the shuffle, so a key
    with very many changes costs no more than any other.
    """
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*log.columns), F.struct(order)).alias("row"))
    return last.select("row.*")


def live(state: DataFrame) -> DataFrame:
    """State without deleted keys."""
    return state.where(F.col("op") != "d")


def latest_state(log: DataFrame, keys: Sequence[str], order: str = "lsn") -> DataFrame:
    """Last image per key of a keyed table, deleted keys removed."""
    return live(latest_image(log, keys, order))


def merge_batch(state: DataFrame, changes: DataFrame, keys: Sequence[str], small: bool = False) -> DataFrame:
    """State after a further batch of changes, deletes kept.

    The batch is reduced to one row per key and joined to the state, which is
    read and shuffled once; per key the higher position wins. For a batch that is
    ``small`` next to the state the join keeps to state rows, so Spark can
    broadcast the batch and leave the state where it is; keys that are new are
    then found by a second read of the key columns alone.

    ``state`` has one row per key. Write the result to a new path, never to the
    one ``state`` reads. Keys must not be null.
    """
    columns = state.columns
    last = latest_image(changes.select(*columns), keys)
    held = state.select(*keys, F.struct(*columns).alias("_held"))
    new = last.select(*keys, F.struct(*columns).alias("_new"))
    no_position = F.col("_held.lsn").isNull() & F.col("_new").isNotNull()
    newer = F.col("_held").isNull() | F.coalesce(F.col("_new.lsn") >= F.col("_held.lsn"), no_position)
    merged = held.join(new, list(keys), "left" if small else "full_outer")
    merged = merged.select(F.when(newer, F.col("_new")).otherwise(F.col("_held")).alias("_row")).select("_row.*")
    if not small:
        return merged
    known = state.select(*keys).join(last.select(*keys), list(keys), "left_semi")
    return merged.unionByName(last.join(known, list(keys), "left_anti"))


def current_state(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Snapshot plus the changes of its epoch, deleted keys removed.

    Equals ``latest_state(unify(snapshot, changes))``. As every change beats
    the snapshot row, the snapshot only loses the changed keys and need not be
    grouped or, with few changes, shuffled.
    """
    changed = latest_state(changes.select(*snapshot.columns, "op", "lsn"), keys)
    unchanged = snapshot.join(changes.select(*keys).distinct(), list(keys), "left_anti")
    return unchanged.unionByName(changed.select(*snapshot.columns))


def snapshot_as_of(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    position: int | Column,
) -> DataFrame:
    """State as of one log position.

    Taking every table at the same position gives a consistent set.
    """
    return current_state(base, changes.where(F.col("lsn") <= position), keys)


def snapshot_all_as_of(
    bases: Mapping[str, DataFrame],
    logs: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    position: int | Column,
) -> dict[str, DataFrame]:
    """All tables as of one log position: keyed ones by key, others by insert, uncaptured ones as they are."""

    def as_of(name: str) -> DataFrame:
        if name not in logs:
            return bases[name]
        if name in keys:
            return snapshot_as_of(bases[name], logs[name], keys[name], position)
        return append_only_state(bases[name], logs[name].where(F.col("lsn") <= position))

    return {name: as_of(name) for name in bases}


def after_bookmark(changes: DataFrame, epoch: int) -> DataFrame:
    """Changes that belong to the snapshot of ``epoch``.

    Not a filter on position: a transaction open at the snapshot may commit
    later with earlier positions and is missing from the snapshot.
    """
    return changes.where(F.col("epoch") == epoch)


def append_only_state(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Rows of a table without key: snapshot plus inserts.

    An insert is identified by its position together with its values, so
    redeliveries go and equal rows written twice stay.
    """
    columns = snapshot.columns
    inserts = changes.where(F.col("op").isin("c", "r")).select(*columns, "lsn").distinct()
    return snapshot.unionAll(inserts.select(*columns))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes between two states of a keyed table: the keys, op, before, after."""

    def image(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*old.columns).alias(name))

    pairs = image(old, "before").join(image(new, "after"), list(keys), "full_outer")
    operation = (
        F.when(F.col("before").isNull(), F.lit("c"))
        .when(F.col("after").isNull(), F.lit("d"))
        .otherwise(F.lit("u"))
    )
    return pairs.where(~F.col("before").eqNullSafe(F.col("after"))).select(
        *keys, operation.alias("op"), "before", "after"
    )


def multiset_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes between two states of a table without key: op (c or d), before, after.

    Rows count as often as they occur: each state signs its rows, equal rows are
    summed, and what is left over is inserted or deleted that many times. Copies
    are summed before the shuffle, so a row repeated very often costs no more
    than any other. Nulls are equal to each other. Tables without key know no
    updates: a changed row is one delete and one insert.
    """
    columns = old.columns
    signed = old.select(*columns, F.lit(-1).cast("bigint").alias("_sign")).unionByName(
        new.select(*columns, F.lit(1).cast("bigint").alias("_sign"))
    )
    left = signed.groupBy(*columns).agg(F.sum("_sign").alias("_left")).where("_left <> 0")
    image, created = F.struct(*columns), F.col("_left") > 0
    return left.select(
        F.when(created, "c").otherwise("d").alias("op"),
        F.when(~created, image).alias("before"),
        F.when(created, image).alias("after"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_left"))).alias("_copy"),
    ).drop("_copy")


def apply_multiset(old: DataFrame, changes: DataFrame) -> DataFrame:
    """The rows of a table without key after the changes that ``multiset_diff`` found."""
    columns = old.columns
    signed = old.select(*columns, F.lit(1).cast("bigint").alias("_sign"))
    for image, sign in (("before", -1), ("after", 1)):
        rows = changes.where(F.col(image).isNotNull())
        signed = signed.unionByName(rows.select(f"{image}.*", F.lit(sign).cast("bigint").alias("_sign")))
    left = signed.groupBy(*columns).agg(F.sum("_sign").alias("_left")).where("_left > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), "_left")).alias("_copy")
    return left.select(*columns, copies).drop("_copy")
