"""Lateness of deliveries, summed over micro-batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import lateness

DAY = dt.date(2024, 1, 10)


def events(spark, hours, day=DAY):
    """Events that happened so many hours before the day of their delivery; None has no time."""
    midnight = dt.datetime.combine(day, dt.time())
    rows = [(day, None if h is None else midnight - dt.timedelta(hours=h)) for h in hours]
    return lateness.with_lateness(spark.createDataFrame(rows, "dt date, event_time timestamp_ntz"))


def stored(spark, tmp_path, batches):
    for n, batch in enumerate(batches):
        lateness.summarize(batch).write.mode("overwrite").parquet(f"{tmp_path}/late/{n:09d}")
    return lateness.read_lateness(spark, f"{tmp_path}/late")


def test_lateness_of_single_events(spark):
    found = events(spark, [5, 0, -3, None]).orderBy(F.col("event_time").asc_nulls_last()).collect()
    assert [r.late_seconds for r in found] == [5 * 3600, 0, 0, None]


def test_batches_add_up(spark, tmp_path):
    next_day = DAY + dt.timedelta(days=1)
    batches = [events(spark, [1, None, -2]), events(spark, range(100)), events(spark, [None], next_day)]
    first, second = stored(spark, tmp_path, batches).orderBy("dt").collect()
    assert (first.events, first.late, first.untimed, first.longest) == (103, 100, 1, 99 * 3600)
    assert [round(x / 3600) for x in first.within] == [pytest.approx(s * 100, abs=4) for s in lateness.SHARES]
    assert (second.events, second.late, second.untimed, second.longest, second.within) == (1, 0, 1, None, None)


def test_a_repeated_batch_counts_once(spark, tmp_path):
    batch = events(spark, [1, 2, 3])
    stored(spark, tmp_path, [batch, batch])
    assert stored(spark, tmp_path, [batch, batch]).first().events == 6


def test_delay_of_a_watermark(spark, tmp_path):
    days = stored(spark, tmp_path, [events(spark, range(1, 101)), events(spark, [500], DAY + dt.timedelta(days=1))])
    assert lateness.delay_for(days).first()[0] == 500 * 3600
    assert lateness.delay_for(days, 0.9).first()[0] / 3600 == pytest.approx(90, abs=4)
    assert lateness.delay_for(days.where(F.lit(False))).first()[0] is None
    assert lateness.delay_for(days.where(F.lit(False)), 0.5).first()[0] is None


def test_many_batches_of_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    late = events(spark, [24 * 40, *range(120)]).select("dt", "event_time")
    late.repartition(30).write.parquet(source)
    stream = spark.readStream.schema("dt date, event_time timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(source)
    for _ in range(2):  # the second run has nothing to add
        lateness.lateness_stream(
            lateness.with_lateness(stream), f"{tmp_path}/late", f"{tmp_path}/checkpoint", interval=None
        ).awaitTermination()
    row = lateness.read_lateness(spark, f"{tmp_path}/late").first()
    assert (row.events, row.late, row.untimed, row.longest) == (121, 120, 0, 40 * 86_400)


def test_no_summaries(spark, tmp_path):
    with pytest.raises(ValueError, match="no summaries"):
        lateness.read_lateness(spark, str(tmp_path))
