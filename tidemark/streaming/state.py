"""Deduplication and continuous latest state.

The stored state is a folder of Parquet: ``base/N`` holds the state up to
micro-batch N, ``delta/N`` the last image per key of batch N. A batch writes
only its delta; every so many batches base and deltas become a new base. So
the cost of a batch follows its own size, not that of the state. Rows order by
log position throughout, whatever day or batch brought them, and deletes stay
as rows with their position.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import latest_image, live, merge_batch
from tidemark.streaming.files import delete_folder, finished_folders
from tidemark.streaming.log import ROLL_INTERVAL, dropped_rows, start


#: Changes are small next to a state of over so many times as many rows.
SMALL_SHARE = 20


def _first_of_copies(identity: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keep the first row per identity of each Arrow batch."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = pa.table({c: batch.column(c) for c in identity} | {"_row": np.arange(batch.num_rows)})
            first = named.group_by(list(identity)).aggregate([("_row", "min")])
            yield batch.take(first["_row_min"].combine_chunks())

    return reduce


def dedupe_stream(
    stream: DataFrame,
    delay: str,
    event_time: str = "event_time",
    identity: Sequence[str] = ("table", "key", "lsn", "op"),
) -> DataFrame:
    """First delivery of each event, with state kept for ``delay`` of event time.

    ``delay`` must cover both how late a copy may come and how far out of
    order events arrive: older events count as too late and are dropped. Spark
    counts them; ``fail_if_dropped`` turns that into an error. Where no bound on
    lateness is known, use ``append_stream``, which is exact.

    A streaming deduplication has no partial step of its own and moves every
    copy of an event to one task. So copies are first reduced within each Arrow
    batch, before the shuffle: an event that fills a third of the log is then
    at most one row per batch.
    """
    reduced = stream.mapInArrow(_first_of_copies(identity), stream.schema)
    return reduced.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(identity))


def fail_if_dropped(spark: SparkSession, query: StreamingQuery) -> None:
    """Raise if any micro-batch of this run left out rows behind the watermark.

    The run has to be started by this library, which counts from its first
    micro-batch on, however many there are.
    """
    dropped = dropped_rows(spark).of(query)
    if dropped:
        raise ValueError(f"{dropped} events came later than the delay and were left out; give a longer delay")


def latest_image_stream(stream: DataFrame, keys: Sequence[str], order: str = "lsn") -> DataFrame:
    """Last image per key as a stateful aggregate, for output mode ``update``.

    Spark's state store holds one row per key; each micro-batch emits the keys
    it changed. For sinks that can replace rows by key.
    """
    return latest_image(stream, keys, order)


def _parts(spark: SparkSession, path: str, before: int | None = None) -> tuple[int | None, list[int]]:
    """Newest base, older than ``before`` if given, and the deltas after it."""
    bases = [n for n in finished_folders(spark, f"{path}/base") if before is None or n < before]
    base = bases[-1] if bases else None
    deltas = [
        n
        for n in finished_folders(spark, f"{path}/delta")
        if (base is None or n > base) and (before is None or n <= before)
    ]
    return base, deltas


def _merged(spark: SparkSession, path: str, keys: Sequence[str], base: int | None, deltas: list[int]) -> DataFrame:
    if base is None and not deltas:
        raise ValueError(f"no state below {path}")
    state = None if base is None else spark.read.parquet(f"{path}/base/{base:09d}")
    if not deltas:
        return state
    changes = spark.read.parquet(*(f"{path}/delta/{n:09d}" for n in deltas))
    if state is None:
        return latest_image(changes, keys)
    # Row counts stand in the file footers.
    return merge_batch(state, changes, keys, small=changes.count() * SMALL_SHARE < state.count())


def _numbers_from(spark: SparkSession, path: str, checkpoint: str, take_over: bool) -> int:
    """What to add to the batch ids of a query, so that its parts follow all earlier ones.

    Spark gives every new checkpoint an id, and counts its batches from 0. The
    first batch of an id is entered in ``path/owner`` with the number it starts
    from; state that belongs to another id is refused unless ``take_over``.
    """
    query = json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]
    entries = finished_folders(spark, f"{path}/owner")
    for n in entries:
        if spark.read.text(f"{path}/owner/{n:09d}").first().value == query:
            return n
    parts = [n for kind in ("base", "delta", "rows") for n in finished_folders(spark, f"{path}/{kind}")]
    if (parts or entries) and not take_over:
        raise ValueError(f"{path} holds state of another checkpoint; pass take_over=True to go on from it")
    start = max([-1, *parts, *entries]) + 1
    entry = spark.range(1).select(F.lit(query).alias("value"))
    entry.coalesce(1).write.mode("overwrite").text(f"{path}/owner/{start:09d}")
    return start


def apply_batch(changes: DataFrame, batch_id: int, path: str, keys: Sequence[str], compact_every: int = 20) -> None:
    """Add one micro-batch to the stored state; repeating a batch changes nothing."""
    spark = changes.sparkSession
    latest_image(changes, keys).write.mode("overwrite").parquet(f"{path}/delta/{batch_id:09d}")
    if (batch_id + 1) % compact_every == 0:
        compact(spark, path, keys, batch_id)


def compact(spark: SparkSession, path: str, keys: Sequence[str], batch_id: int) -> None:
    """Write base and deltas up to ``batch_id`` as a new base.

    The parts it was made of stay until the next compaction, for running
    readers and for a repeat of this one.
    """
    base, deltas = _parts(spark, path, before=batch_id)
    _merged(spark, path, keys, base, deltas).write.mode("overwrite").parquet(f"{path}/base/{batch_id:09d}")
    if base is None:
        return
    for kind, outdated in (("base", lambda n: n < base), ("delta", lambda n: n <= base)):
        for n in finished_folders(spark, f"{path}/{kind}"):
            if outdated(n):
                delete_folder(spark, f"{path}/{kind}/{n:09d}")


def upsert_stream(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    checkpoint: str,
    interval: str | None = ROLL_INTERVAL,
    compact_every: int = 20,
    take_over: bool = False,
) -> StreamingQuery:
    """Keep the latest state of a keyed table below ``path``.

    ``stream`` holds flat change rows with ``op`` and ``lsn``. State written
    under another checkpoint, or under one that was lost, is only gone on with
    if ``take_over`` says so.
    """
    first: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not first:
            first.append(_numbers_from(batch.sparkSession, path, checkpoint, take_over))
        apply_batch(batch, first[0] + batch_id, path, keys, compact_every)

    return start(stream.writeStream.foreachBatch(write), checkpoint, interval)


def stored_state(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The stored state with its deletes."""
    return _merged(spark, path, keys, *_parts(spark, path))


def read_state(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The stored state, deleted keys removed."""
    return live(stored_state(spark, path, keys))


#: Log positions in one segment: no more share a window.
SEEN_SEGMENT = 1 << 18

#: Log positions in one block are 2 to this power: stored rows are picked for a comparison by blocks.
BLOCK_BITS = 9

#: So many blocks are broadcast; where there are more, Spark decides.
FEW_BLOCKS = 500_000

_SPANS = "segment bigint, first bigint, last bigint"


def _islands(spans: DataFrame) -> DataFrame:
    """(segment, first, last): spans of log positions merged where they overlap or meet, per segment."""
    order = Window.partitionBy("segment").orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("first") > reached + 1, F.lit(True)).cast("int")
    island = F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = spans.withColumn("begins", starts).withColumn("island", island)
    return marked.groupBy("segment", "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("island")


def _positions(rows: DataFrame) -> DataFrame:
    """Log positions of rows as spans of one, or of 64 where those are all there.

    64 positions are the bits of one number, so a log without gaps shuffles a 64th of them.
    """
    lsn = rows.where(F.col("lsn").isNotNull()).select(F.col("lsn").cast("bigint").alias("lsn"))
    bit = F.expr("shiftleft(1L, CAST(lsn & 63 AS INT))")
    words = lsn.groupBy(F.shiftright("lsn", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    start = F.col("word") * 64

    def span(first: Column, last: Column) -> Column:
        return F.struct(first.alias("first"), last.alias("last"))

    there = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit("bits", i) == 1)
    spans = F.when(F.col("bits") == -1, F.array(span(start, start + 63))).otherwise(
        F.transform(there, lambda i: span(start + i, start + i))
    )
    return words.select(F.floor(start / SEEN_SEGMENT).alias("segment"), F.inline(spans))


def _common(one: DataFrame, other: DataFrame) -> DataFrame:
    """(first, last): spans of the log positions that stand in both, each found once per pair of spans at most.

    Of two spans that overlap, the one that begins later sees how far those of the other side have reached.
    """
    both = one.withColumn("side", F.lit(True)).unionByName(other.withColumn("side", F.lit(False)))
    along = Window.partitionBy("segment").orderBy("first").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reached = [F.max(F.when(F.col("side") == side, F.col("last"))).over(along) for side in (True, False)]
    met = both.withColumn("reached", F.when(F.col("side"), reached[1]).otherwise(reached[0]))
    return met.where(F.col("reached") >= F.col("first")).select("first", F.least("last", "reached").alias("last"))


def _seen(spark: SparkSession, path: str, number: int) -> tuple[int | None, list[str]]:
    """Newest base of positions seen before micro-batch ``number``, and the folders that hold them all."""
    bases = [n for n in finished_folders(spark, f"{path}/seen/base") if n < number]
    base = bases[-1] if bases else None
    deltas = [n for n in finished_folders(spark, f"{path}/seen/delta") if n < number and (base is None or n > base)]
    folders = ([] if base is None else [f"base/{base:09d}"]) + [f"delta/{n:09d}" for n in deltas]
    return base, [f"{path}/seen/{f}" for f in folders]


def _near(spark: SparkSession, path: str, number: int, spans: DataFrame, placed: bool) -> DataFrame | None:
    """Rows stored before micro-batch ``number`` in the blocks where its ``spans`` hold positions that were seen.

    Rows without a position are among them always, and all are where copies may
    differ in position (not ``placed``). None if nothing is stored.
    """
    stored = [n for n in finished_folders(spark, f"{path}/rows") if n < number]
    if not stored:
        return None
    rows = spark.read.parquet(*(f"{path}/rows/{n:09d}" for n in stored))
    if not placed:
        return rows
    _, folders = _seen(spark, path, number)
    if not folders:
        # Rows that were stored before positions were kept.
        folders = [f"{path}/seen/base/{stored[-1]:09d}"]
        _islands(_positions(rows)).write.mode("overwrite").parquet(*folders)
    again = _common(spans, spark.read.schema(_SPANS).parquet(*folders))
    ends = [F.shiftright(c, BLOCK_BITS) for c in ("first", "last")]
    low, high, count = again.agg(F.min("first"), F.max("last"), F.sum(ends[1] - ends[0] + 1)).first()
    if low is None:
        return rows.where(F.col("lsn").isNull())
    blocks = again.select(F.explode(F.sequence(*ends)).alias("_block")).unionAll(
        spark.range(1).select(F.lit(None).cast("bigint"))
    )
    near = rows.where(F.col("lsn").between(low, high) | F.col("lsn").isNull())
    here = F.shiftright(F.col("lsn").cast("bigint"), BLOCK_BITS).eqNullSafe(F.col("_block"))
    return near.join(F.broadcast(blocks) if count <= FEW_BLOCKS else blocks, here, "left_semi")


def _not_stored(arrived: DataFrame, near: DataFrame | None, identity: Sequence[str]) -> DataFrame:
    """One row per identity of ``arrived`` that is not among the stored rows ``near``, by one shuffle of both."""
    if near is None:
        return arrived.dropDuplicates(list(identity))
    marked = arrived.withColumn("_stored", F.lit(False)).unionByName(
        near.select(*identity).withColumn("_stored", F.lit(True)), allowMissingColumns=True
    )
    keys = {c.lower() for c in identity}
    others = [F.first(c).alias(c) for c in arrived.columns if c.lower() not in keys]
    found = marked.groupBy(*identity).agg(*others, F.max("_stored").alias("_stored"))
    return found.where(~F.col("_stored")).select(*arrived.columns)


def append_batch(batch: DataFrame, number: int, path: str, identity: Sequence[str] | None, compact_every: int = 20) -> None:
    """Store the inserts of one micro-batch that are not stored yet; repeating a batch changes nothing."""
    spark = batch.sparkSession
    identity = list(identity or batch.columns)
    part, delta = f"{path}/arrived/{number:09d}", f"{path}/seen/delta/{number:09d}"
    batch.where(F.col("op").isin("c", "r")).write.mode("overwrite").parquet(part)
    arrived = spark.read.schema(batch.schema).parquet(part)
    # Before the rows, so that none is ever stored at a position that counts as new.
    _islands(_positions(arrived)).write.mode("overwrite").parquet(delta)
    near = _near(spark, path, number, spark.read.schema(_SPANS).parquet(delta), "lsn" in map(str.lower, identity))
    _not_stored(arrived, near, identity).write.mode("overwrite").parquet(f"{path}/rows/{number:09d}")
    delete_folder(spark, part)
    if (number + 1) % compact_every == 0:
        before, _ = _seen(spark, path, number)
        _, folders = _seen(spark, path, number + 1)
        _islands(spark.read.schema(_SPANS).parquet(*folders)).write.mode("overwrite").parquet(f"{path}/seen/base/{number:09d}")
        # What the base before this one was made of; that base stays for a repeat of this batch.
        for kind, outdated in (("base", lambda n: n < before), ("delta", lambda n: n <= before)):
            for n in finished_folders(spark, f"{path}/seen/{kind}") if before is not None else ():
                if outdated(n):
                    delete_folder(spark, f"{path}/seen/{kind}/{n:09d}")


def append_stream(
    stream: DataFrame,
    path: str,
    identity: Sequence[str] | None,
    checkpoint: str,
    interval: str | None = ROLL_INTERVAL,
    take_over: bool = False,
) -> StreamingQuery:
    """Collect the inserts of a table without key; ``read_appended`` gives its rows.

    Copies are rows equal in ``identity``, by default in every column, position
    included: rows of one insert share a position, so it does not do alone.

    Every insert is stored once, however late a copy comes. Positions that were
    seen are kept as merged spans next to the rows. A batch meets its own spans
    with those, and reads stored rows only in blocks where both have positions;
    one shuffle compares them with its rows and these with each other. Without
    position in ``identity``, every batch is compared with all stored rows.
    Rows of another checkpoint are kept and added to only with ``take_over``.
    """
    first: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not first:
            first.append(_numbers_from(batch.sparkSession, path, checkpoint, take_over))
        append_batch(batch, first[0] + batch_id, path, identity)

    return start(stream.writeStream.foreachBatch(write), checkpoint, interval)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all finished micro-batches; each insert is stored once."""
    parts = finished_folders(spark, f"{path}/rows")
    if not parts:
        raise ValueError(f"no rows below {path}")
    return spark.read.parquet(*(f"{path}/rows/{n:09d}" for n in parts))
