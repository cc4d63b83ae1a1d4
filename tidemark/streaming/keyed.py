"""Keyed state in the streaming engine: newest images, and illegal steps as they happen."""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.schemas import allowed_transitions
from tidemark.streaming.log import start

DAY_MS = 24 * 60 * 60 * 1000

# For the queries started here alone. State with limits and maps is only offered by this store,
# which lives on disk; and state with a limit would have batches run without input for ever.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


class NewestImage(StatefulProcessor):
    """Passes on a key's newest change of each micro-batch, if it is newer than all before.

    A living key is remembered by its position for good, a deleted one for a
    limited time.
    """

    def __init__(self, order: str, remember_ms: int):
        self.order, self.remember_ms = order, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.alive = handle.getValueState("alive", "position bigint")
        self.gone = handle.getValueState("gone", "position bigint", self.remember_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        newest = max(rows, key=lambda row: row[self.order])
        position = newest[self.order]
        known = self.alive.get() or self.gone.get()
        if known and position <= known[0]:
            return
        if newest["op"] == "d":
            self.alive.clear()
            self.gone.update((position,))
        else:
            self.gone.clear()
            self.alive.update((position,))
        yield newest

    def close(self) -> None:
        pass


#: Changes of a key that are read and written together; a chunk of twice as many is cut.
CHUNK = 512


class LifeCycle(StatefulProcessor):
    """Judges each step between neighbouring positions of a key, and takes back what a late change parts.

    The history lies in the state store in chunks of neighbouring changes, by the position
    the chunk starts at; the first has no start. Of a micro-batch only those chunks are read and
    written that its changes fall into, and a neighbour of them at most. Calls to the store cost far
    more than what is in them, and a key with few changes has one chunk.
    """

    def __init__(self, columns: Sequence[str], chunk: int = CHUNK):
        self.allowed = set(allowed_transitions())
        self.step = Row(*columns)
        self.chunk = chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        # JSON of [start, ...], of all chunks but the first, and [[position, status, gone], ...] of the first.
        self.head = handle.getValueState("head", "starts string, steps string")
        self.chunks = handle.getMapState("chunks", "start bigint", "steps string")

    def judge(self, key, before: Sequence | None, after: Sequence, weight: int) -> Iterator[Row]:
        """A row if the step from ``before`` to ``after`` (position, status, gone) is illegal."""
        position, status, gone = after
        if gone:
            return
        is_first = before is None or before[2]
        previous = None if is_first else before[1]
        known = is_first or previous is not None
        if not (known and (previous, status) in self.allowed):
            yield self.step(*key, position, previous, status, is_first, weight)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        head = self.head.get()
        starts, first = (json.loads(head[0]), json.loads(head[1])) if head else ([], [])
        # Chunk n begins at starts[n - 1].
        read, changed = {0: first}, set()

        def chunk(n: int) -> list[list]:
            if n not in read:
                read[n] = json.loads(self.chunks.getValue((starts[n - 1],))[0])
            return read[n]

        # Of copies the last one counts, as it always has.
        news = {row[0]: [row[0], row[1], row[2]] for row in ((r["position"], r["status"], r["gone"]) for r in rows)}
        for position in sorted(news):
            n, step = bisect_right(starts, position), news[position]
            steps = chunk(n)
            at = bisect_left(steps, position, key=itemgetter(0))
            if at < len(steps) and steps[at][0] == position:
                continue
            before = steps[at - 1] if at else chunk(n - 1)[-1] if n else None
            after = steps[at] if at < len(steps) else chunk(n + 1)[0] if n < len(starts) else None
            if after is not None:
                yield from self.judge(key, before, after, -1)
            yield from self.judge(key, before, step, 1)
            if after is not None:
                yield from self.judge(key, step, after, 1)
            steps.insert(at, step)
            changed.add(n)
        if not changed:
            return
        added = []
        for n in sorted(changed):
            steps, start = read[n], starts[n - 1] if n else None
            cuts = range(0, len(steps), self.chunk) if len(steps) >= 2 * self.chunk else [0]
            for cut in cuts:
                part = steps[cut : cut + self.chunk] if len(cuts) > 1 else steps
                if cut:
                    start = part[0][0]
                    added.append(start)
                if start is None:
                    first = part
                else:
                    self.chunks.updateValue((start,), (json.dumps(part),))
        if added or 0 in changed:
            self.head.update((json.dumps(sorted([*starts, *added])), json.dumps(first)))

    def close(self) -> None:
        pass


def _keyed(stream: DataFrame, key: str, processor: StatefulProcessor, schema: T.StructType) -> DataFrame:
    return stream.groupBy(key).transformWithState(processor, schema, "Append", "ProcessingTime")


def start_keyed(writer: DataStreamWriter, checkpoint: str, interval: str | None) -> StreamingQuery:
    """As ``log.start``, for streams with state of this module."""
    conf = writer._spark.conf
    before = {name: conf.get(name, None) for name in _SETTINGS}
    try:
        for name, value in _SETTINGS.items():
            conf.set(name, value)
        return start(writer, checkpoint, interval)  # the query keeps the settings it starts with
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def newest_images(stream: DataFrame, key: str, order: str = "lsn", remember_days: float = 7) -> DataFrame:
    """A log of newest images, deletes included, from a stream of flat changes.

    Of each key and micro-batch at most the newest change passes, and only if
    its position lies behind all earlier ones, so repeated and late changes
    are dropped. A task holds one change per key. A deleted key is forgotten
    ``remember_days`` after the delete was processed; an older change that
    arrives later than that counts as new. Keys and positions must not be null.
    """
    return _keyed(stream, key, NewestImage(order, int(remember_days * DAY_MS)), stream.schema)


def watch_life_cycles(
    stream: DataFrame, key: str = "order_id", status: str = "order_status", order: str = "lsn"
) -> DataFrame:
    """Steps the life cycle does not allow, as they happen: key, position, previous, status, is_first, weight.

    A delete ends a history, and the next change begins one. Copies of a change
    are skipped, however late. A change that arrives behind later ones of its
    key is judged against its neighbours; a step it parts, reported before,
    comes again with weight -1. ``settled_steps`` sums the weights. Positions
    and statuses of one key's changes in a micro-batch are sorted in memory, next to
    the chunks of its history they fall into.
    """
    key_type = stream.schema[key].dataType
    steps = stream.select(
        key, F.col(order).alias("position"), F.col(status).alias("status"), (F.col("op") == "d").alias("gone")
    )
    schema = T.StructType(
        [
            T.StructField(key, key_type),
            T.StructField(order, T.LongType()),
            T.StructField("previous_status", T.StringType()),
            T.StructField("status", T.StringType()),
            T.StructField("is_first", T.BooleanType()),
            T.StructField("weight", T.IntegerType()),
        ]
    )
    return _keyed(steps, key, LifeCycle(schema.names), schema)


def settled_steps(reported: DataFrame) -> DataFrame:
    """The illegal steps that stand, from all rows ``watch_life_cycles`` has reported."""
    columns: list[Column] = [F.col(c) for c in reported.columns if c != "weight"]
    return reported.groupBy(*columns).agg(F.sum("weight").alias("weight")).where("weight > 0").drop("weight")
