"""Latest state in a bucketed table: a batch shuffles itself and rewrites what it touches.

The table is partitioned by slot (a hash of the key) and version, and clustered
by the key into buckets. A merge reads the slots its batch falls into, joins the
batch to them bucket by bucket, and writes those slots anew under the next
version; all others stay as they are. A version counts once it is committed, so
readers see the state before or after a batch, and a broken write is never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import latest_image, live, merge_batch
from tidemark.session import scratch_dir
from tidemark.streaming.files import delete_folder, folder_numbers, make_folder
from tidemark.streaming.log import ROLL_INTERVAL, start

SLOT, VERSION = "_slot", "_version"


def open_state(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    slots: int = 256,
    buckets: int | None = None,
) -> None:
    """Create the table over ``path``, or take up what lies there.

    ``schema`` is that of flat change rows, ``op`` and ``lsn`` included. One file
    holds a bucket of a slot: choose slots times buckets as about the state's
    size over 128 MB, and no fewer buckets than cores. Both have to stay the same
    over the life of the state. There are as many buckets as the session has
    shuffle partitions unless given.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    clustered = ", ".join(f"`{k}`" for k in keys)
    make_folder(spark, path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {SLOT} INT, {VERSION} BIGINT) USING parquet "
        f"OPTIONS (path '{path}') PARTITIONED BY ({SLOT}, {VERSION}) CLUSTERED BY ({clustered}) INTO {buckets} BUCKETS "
        f"TBLPROPERTIES ('slots' = '{slots}', 'keys' = '{','.join(keys)}')"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")


def _setting(spark: SparkSession, name: str, key: str) -> str:
    return spark.sql(f"SHOW TBLPROPERTIES {name} ('{key}')").first()["value"]


def _path(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def _versions(spark: SparkSession, name: str) -> dict[int, list[int]]:
    """Committed versions of every slot, ascending; from the catalog, no data is read."""
    committed = set(folder_numbers(spark, f"{_path(spark, name)}/_committed"))
    found: dict[int, list[int]] = {}
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        slot, version = (int(part.split("=")[1]) for part in row["partition"].split("/"))
        if version in committed:
            found.setdefault(slot, []).append(version)
    return {slot: sorted(versions) for slot, versions in found.items()}


def _newest(versions: dict[int, list[int]], slots: Sequence[int] | None = None) -> Column:
    """Condition on the partition columns alone: the newest version of each slot."""
    pairs = [(s, v[-1]) for s, v in sorted(versions.items()) if slots is None or s in slots]
    if not pairs:
        return F.lit(False)
    return F.concat_ws("/", SLOT, VERSION).isin([f"{s}/{v}" for s, v in pairs])


def stored_buckets(spark: SparkSession, name: str, slots: Sequence[int] | None = None) -> DataFrame:
    """The stored state with its deletes, or that of some slots."""
    return spark.table(name).where(_newest(_versions(spark, name), slots)).drop(SLOT, VERSION)


def read_buckets(spark: SparkSession, name: str) -> DataFrame:
    """The stored state, deleted keys removed."""
    return live(stored_buckets(spark, name))


def merge_into_buckets(changes: DataFrame, name: str) -> int:
    """Add a batch of flat change rows; returns how many slots were written.

    Positions decide, so repeating a batch, or one that was broken off, leaves
    the same state. One writer at a time. A batch of n keys rewrites n slots at
    most; it pays where a batch falls into few of them, or state is small next
    to the batches, and else comes down to one rewrite without a shuffle.
    """
    spark = changes.sparkSession
    keys, slots = _setting(spark, name, "keys").split(","), int(_setting(spark, name, "slots"))
    path, columns = _path(spark, name), spark.table(name).drop(SLOT, VERSION).columns
    slot = F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")
    staged = scratch_dir(spark, "batch")
    latest_image(changes.select(*columns), keys).withColumn(SLOT, slot).write.parquet(staged)
    batch = spark.read.parquet(staged)
    # At most as many numbers as there are slots.
    touched = [row[0] for row in batch.select(SLOT).distinct().collect()]
    if not touched:
        return 0
    version = max([-1, *folder_numbers(spark, f"{path}/_committed")]) + 1
    for part in spark.sql(f"SHOW PARTITIONS {name}").collect():
        # What a broken write of this version left.
        if part["partition"].endswith(f"{VERSION}={version}"):
            _drop(spark, name, path, part["partition"])
    merged = merge_batch(stored_buckets(spark, name, touched), batch.drop(SLOT), keys)
    merged.select(*columns, slot.alias(SLOT), F.lit(version).cast("bigint").alias(VERSION)).write.insertInto(name)
    make_folder(spark, f"{path}/_committed/{version}")
    return len(touched)


def _drop(spark: SparkSession, name: str, path: str, partition: str) -> None:
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition.replace('/', ', ')})")
    delete_folder(spark, f"{path}/{partition}")


def drop_outdated(spark: SparkSession, name: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` versions of every slot; returns how many went.

    Readers of an older state have to be done.
    """
    path, gone = _path(spark, name), 0
    for slot, versions in _versions(spark, name).items():
        for version in versions[:-keep]:
            _drop(spark, name, path, f"{SLOT}={slot}/{VERSION}={version}")
            gone += 1
    return gone


def upsert_buckets(
    stream: DataFrame, name: str, checkpoint: str, interval: str | None = ROLL_INTERVAL, keep: int = 2
) -> StreamingQuery:
    """Keep the latest state of a keyed table in ``name``, one version per micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_into_buckets(batch, name)
        drop_outdated(batch.sparkSession, name, keep)

    return start(stream.writeStream.foreachBatch(write), checkpoint, interval)
