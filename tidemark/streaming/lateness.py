"""How late events are delivered, over all micro-batches of a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import micros_of
from tidemark.streaming.files import finished_folders
from tidemark.streaming.log import ROLL_INTERVAL, start

#: Size of a quantile sketch; ranks are off by about 1.65 % at most, in 99 of 100 cases.
SKETCH_K = 200

#: Shares whose lateness is reported.
SHARES = (0.5, 0.9, 0.99)


def with_lateness(events: DataFrame, event_time: str = "event_time", delivered: str = "dt") -> DataFrame:
    """``events`` with ``late_seconds``: whole seconds from the event to the start of its delivery day.

    Events delivered on their own day, or before it, have 0; without time or day it is null.
    """
    gap = F.floor((micros_of(F.col(delivered).cast("timestamp_ntz")) - micros_of(event_time)) / 1_000_000)
    # ``greatest`` would pass over a null.
    return events.withColumn("late_seconds", F.when(gap < 0, 0).otherwise(gap).cast("bigint"))


def summarize(events: DataFrame, delivered: str = "dt", k: int = SKETCH_K) -> DataFrame:
    """One row per delivery day: events, late and untimed ones, the longest lateness, a quantile sketch.

    Sketches are built in each task and merged, so a day is no group of rows.
    """
    return events.groupBy(delivered).agg(
        F.count("*").alias("events"),
        F.count_if(F.col("late_seconds") > 0).alias("late"),
        F.count_if(F.col("late_seconds").isNull()).alias("untimed"),
        F.max("late_seconds").alias("longest"),
        F.kll_sketch_agg_bigint("late_seconds", k).alias("sketch"),
    )


def lateness_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = ROLL_INTERVAL,
    delivered: str = "dt",
    k: int = SKETCH_K,
) -> StreamingQuery:
    """Keep the summaries of every micro-batch below ``path``; ``read_lateness`` merges them.

    ``stream`` comes from ``with_lateness``. A micro-batch writes one row per delivery day in it, under its
    own number, so a repeated one replaces itself. No state and no watermark is
    needed: what a watermark would leave out is counted too.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        summarize(batch, delivered, k).write.mode("overwrite").parquet(f"{path}/{batch_id:09d}")

    return start(stream.writeStream.foreachBatch(write), checkpoint, interval)


def merged(summaries: DataFrame, delivered: str = "dt") -> DataFrame:
    """Summaries of several micro-batches, one row per delivery day again."""
    return summaries.groupBy(delivered).agg(
        *(F.sum(c).alias(c) for c in ("events", "late", "untimed")),
        F.max("longest").alias("longest"),
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
    )


def read_lateness(spark: SparkSession, path: str, delivered: str = "dt", shares: Sequence[float] = SHARES) -> DataFrame:
    """Per delivery day: events, late, untimed, longest, and ``within``, the seconds within which each share came.

    Counts and the longest are exact. ``within`` has one entry per share, from the
    merged sketch; it is null for a day without any timed event.
    """
    parts = finished_folders(spark, path)
    if not parts:
        raise ValueError(f"no summaries below {path}")
    days = merged(spark.read.parquet(*(f"{path}/{n:09d}" for n in parts)), delivered)
    timed = F.col("events") > F.col("untimed")
    quantile: Column = F.kll_sketch_get_quantile_bigint("sketch", F.array(*map(F.lit, shares)))
    return days.select(delivered, "events", "late", "untimed", "longest", F.when(timed, quantile).alias("within"), "sketch")


def delay_for(days: DataFrame, share: float = 1.0) -> DataFrame:
    """(delay_seconds): how long a watermark has to wait for a share of all events; one row.

    ``days`` is ``read_lateness``. A share of 1 is exact and leaves no event out, smaller
    ones are from the sketch.
    """
    merged_all = F.kll_merge_agg_bigint("sketch")
    whole = days.agg(F.max("longest").alias("longest"), F.when(F.max("longest").isNotNull(), merged_all).alias("sketch"))
    if share >= 1:
        return whole.select(F.col("longest").alias("delay_seconds"))
    quantile = F.kll_sketch_get_quantile_bigint("sketch", F.lit(share))
    return whole.select(F.when(F.col("longest").isNotNull(), quantile).alias("delay_seconds"))
