"""Manifest of snapshot epochs.

Each snapshot opens an epoch. Changes are merged into the snapshot of their
own epoch only, so files left over from an earlier one do no harm.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "epoch int, position bigint"


def epochs(spark: SparkSession, root: str) -> DataFrame:
    """All recorded epochs with the log position their snapshot was taken at."""
    return spark.read.schema(_SCHEMA).json(f"{root}/_epochs")


def open_epoch(spark: SparkSession, root: str, epoch: int, position: int) -> None:
    """Record an epoch; one row per snapshot run."""
    row = spark.createDataFrame([(epoch, position)], _SCHEMA)
    row.coalesce(1).write.mode("append").json(f"{root}/_epochs")


def current_epoch(spark: SparkSession, root: str) -> int | None:
    """Number of the newest epoch: a single aggregated value; None if none was ever opened."""
    try:
        recorded = epochs(spark, root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return recorded.agg(F.max("epoch")).first()[0]
