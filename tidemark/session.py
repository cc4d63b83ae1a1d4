"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE may hash a join side instead of sorting both, but only where the
    # measured shuffle output of every partition stays under this size.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    # Without call sites in error messages, plans are built in half the time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Streaming state larger than executor heap spills to local RocksDB files
    # and is uploaded to the checkpoint folder.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    app: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """Session with the settings the operators are tuned for.

    ``shuffle_partitions`` is the upper bound AQE coalesces down from. AQE
    splits partitions only for joins, so for large inputs give about the
    shuffled bytes divided by 200 MB, and at least the number of cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the folder that all executors share.

    ``spark.checkpoint.dir`` names it. Only in local mode, where there is one
    file system, may it be unset; then Hadoop's scratch folder is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.sparkContext._jsc.hadoopConfiguration().get("hadoop.tmp.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
