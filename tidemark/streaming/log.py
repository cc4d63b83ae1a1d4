"""Stream source and sink over change-log folders."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tidemark.sources.change_log import LINE_OPTIONS, change_log_path, fail_on_faulty, log_schema
from tidemark.streaming.files import make_folder, partition_folders

# A log file is closed after this time, number of bytes or of events.
ROLL_INTERVAL = "300 seconds"
ROLL_BYTES = 104_857_600
ROLL_EVENTS = 10_000

#: Log positions whose events are numbered in one group.
ROLL_SEGMENT = 1 << 24

#: Tasks that list the files of a rolled log.
LISTING_TASKS = 32
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

#: Input of one micro-batch unless told otherwise.
BATCH_BYTES = 16 << 30


def read_change_stream(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType,
    max_files: int | None = None,
    folders: Sequence[str] = ("dt",),
    max_bytes: int = BATCH_BYTES,
    keep_unreadable: bool = False,
) -> DataFrame:
    """Events of one table as they arrive; the folder is created if missing.

    A micro-batch holds ``max_bytes`` of files at most (one file at least), or
    ``max_files`` of them if that is given. An unreadable line stops the query,
    or with ``keep_unreadable`` is kept as text in the column ``unreadable``.
    """
    path = change_log_path(root, table)
    make_folder(spark, path)
    reader = spark.readStream.options(**LINE_OPTIONS).schema(log_schema(schema, folders, unreadable=True))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    events = reader.json(path)
    return events if keep_unreadable else fail_on_faulty(events)


def with_delivery_day(stream: DataFrame) -> DataFrame:
    """Adds ``dt``, the day the micro-batch runs; a repeated batch keeps its day."""
    return stream.withColumn("dt", F.current_date())


class DroppedRows(StreamingQueryListener):
    """Rows left out behind the watermark, summed over all micro-batches of each run."""

    def __init__(self) -> None:
        self.totals: dict[str, int] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.totals[str(event.runId)] = 0

    def onQueryProgress(self, event) -> None:  # noqa: N802
        dropped = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        run = str(event.progress.runId)
        self.totals[run] = self.totals.get(run, 0) + dropped

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.add(str(event.runId))

    def of(self, query: StreamingQuery, wait_seconds: float = 60) -> int:
        """Rows one run has left out so far; of a run that has ended, all of them."""
        run, until = str(query.runId), time.monotonic() + wait_seconds
        while not query.isActive and run not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError(f"no report that run {run} has ended")
            time.sleep(0.01)
        return self.totals.get(run, 0)


_LISTENERS: dict[str, DroppedRows] = {}


def dropped_rows(spark: SparkSession) -> DroppedRows:
    """The session's count, begun with its first stream."""
    session = spark.sparkContext.applicationId + str(spark._jsparkSession.hashCode())
    if session not in _LISTENERS:
        _LISTENERS[session] = DroppedRows()
        spark.streams.addListener(_LISTENERS[session])
    return _LISTENERS[session]


def start(writer: DataStreamWriter, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Start a query that resumes from ``checkpoint``.

    ``interval`` is the time between micro-batches; None processes what is
    there in bounded batches and stops. Rows that come too late are counted
    from the first micro-batch on, see ``dropped_rows``.
    """
    dropped_rows(writer._spark)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def write_change_log(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    interval: str | None = ROLL_INTERVAL,
    events_per_file: int = ROLL_EVENTS,
) -> StreamingQuery:
    """Append routed events (columns ``table`` and ``dt``) to one log per table and day.

    Files roll with each micro-batch and at ``events_per_file``. Every file is
    listed in the sink's commit log, so a repeated batch adds nothing.
    """
    writer = (
        stream.writeStream.format("json")
        .option("path", root)
        .option("maxRecordsPerFile", events_per_file)
        .partitionBy("table", "dt")
    )
    return start(writer, checkpoint, interval)


def number_files(
    lines: DataFrame,
    max_bytes: int = ROLL_BYTES,
    max_events: int = ROLL_EVENTS,
    segment: int = ROLL_SEGMENT,
    order: str = "lsn",
) -> DataFrame:
    """``lines`` (table, dt, position, line) with ``file``, a number within table and day.

    In order of position, a file ends before it would exceed ``max_bytes``,
    line ends included, or ``max_events``; it may end earlier by the longest
    line among those of up to half of ``max_bytes``. Longer lines get a file
    each, numbered -1, -2, … No day forms one group: sizes are summed along
    segments of the log, and only one row per segment is summed along a day.
    A null day or table is a folder like any other.
    """
    day = ["table", "dt"]
    group = [*day, "_segment"]
    size = F.octet_length("line") + F.lit(1).cast("bigint")
    long = F.col("_size") > max_bytes // 2
    sized = lines.withColumn("_size", size).withColumns(
        {
            "_segment": F.floor(F.col(order) / segment),
            "_short": F.when(long, 0).otherwise(F.col("_size")),
            "_one": F.when(long, 0).otherwise(1),
            "_long": F.when(long, 1).otherwise(0),
        }
    )
    # Named explicitly so that both parts below read one and the same shuffle.
    sized = sized.repartition(*group)
    along = Window.partitionBy(*group).orderBy(order, "line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = ("_short", "_one", "_long")
    inside = sized.withColumns({f"{c}_end": F.sum(c).over(along) for c in sums})

    totals = sized.groupBy(*group).agg(*(F.sum(c).alias(c) for c in sums), F.max("_short").alias("_longest"))
    earlier = Window.partitionBy(*day).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *(F.col(c).alias(f"_at{c}") for c in group),
        *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in sums),
        F.max("_longest").over(Window.partitionBy(*day)).alias("_longest"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_at{c}")) for c in group]
    placed = inside.join(offsets, same)
    # A file takes ends from one stretch of ``room`` bytes; its first line may begin before it.
    room = F.lit(max_bytes + 1) - F.col("_longest")
    ends = {c: F.col(f"{c}_end") + F.col(f"{c}_before") for c in sums}
    number = F.floor((ends["_short"] - 1) / room) + F.floor((ends["_one"] - 1) / max_events)
    return placed.withColumn("file", F.when(long, -ends["_long"]).otherwise(number).cast("bigint")).select(
        *lines.columns, "file"
    )


def write_rolled_log(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    interval: str | None = ROLL_INTERVAL,
    max_bytes: int = ROLL_BYTES,
    max_events: int = ROLL_EVENTS,
    segment: int = ROLL_SEGMENT,
) -> StreamingQuery:
    """Like ``write_change_log``, with files that also roll by bytes; the stream needs ``source.lsn``.

    Files roll with each micro-batch and as ``number_files`` says. A
    micro-batch is a folder of its own, so a repeated one replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        event = F.struct(*(c for c in batch.columns if c not in ("table", "dt", "topic")))
        lines = batch.select("table", "dt", F.col("source.lsn").alias("lsn"), F.to_json(event).alias("line"))
        numbered = number_files(lines, max_bytes, max_events, segment)
        files = numbered.repartition("table", "dt", "file").sortWithinPartitions("table", "dt", "file", "lsn", "line")
        files.select("table", "dt", "file", "line").write.mode("overwrite").partitionBy("table", "dt", "file").text(
            f"{root}/batch={batch_id:09d}"
        )

    return start(stream.writeStream.foreachBatch(write), checkpoint, interval)


def read_rolled_log(spark: SparkSession, root: str, schema: T.StructType, table: str) -> DataFrame:
    """Events of one table from the folders of ``write_rolled_log``.

    Only the table's own folders are listed, by one job of up to ``LISTING_TASKS`` tasks:
    left to Spark, every folder of a day with many files is a job, every file a task.
    """
    stored = T.StructType(
        [
            *log_schema(schema).fields,
            T.StructField("batch", T.LongType()),
            T.StructField("table", T.StringType()),
            T.StructField("file", T.LongType()),
        ]
    )
    folders = partition_folders(spark, f"{root}/batch=*/table=*", table)
    if not folders:
        # A table without events is read from an empty folder, so that it has file metadata too.
        make_folder(spark, f"{root}/_empty")
        return spark.read.schema(stored).json(f"{root}/_empty")
    before = spark.conf.get(_LISTING, None)
    spark.conf.set(_LISTING, LISTING_TASKS)
    try:
        # The files are listed here and now, and not again.
        events = spark.read.schema(stored).option("basePath", root).json([f"{f}/dt=*/file=*" for f in folders])
    finally:
        spark.conf.unset(_LISTING) if before is None else spark.conf.set(_LISTING, before)
    return events.where(F.col("table") == table)


def read_change_log(spark: SparkSession, root: str, schema: T.StructType, table: str) -> DataFrame:
    """Events of one table from the folders of ``write_change_log``.

    Reads from the root, where the commit log lies; the table filter skips the
    other tables' folders.
    """
    stored = T.StructType([*log_schema(schema).fields, T.StructField("table", T.StringType())])
    return spark.read.schema(stored).json(root).where(F.col("table") == table)
