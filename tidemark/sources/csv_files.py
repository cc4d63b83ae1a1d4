"""Snapshot files: quoted CSV with a header, one folder per table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import ONE_LINE

# Comma-delimited, double quotes doubled inside quoted values, line breaks
# allowed inside quotes, blanks kept.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    # A value that no field has: so an empty field is null and "" the empty string.
    "nullValue": "\u0001",
    # Else a record of another shape passes where only some columns are read.
    "columnPruning": "false",
}

# Without these Spark would cut timestamps to milliseconds and trim values.
WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def snapshot_path(root: str, table: str) -> str:
    return f"{root}/{table}/snapshot"


def may_hold_line_breaks(schema: T.StructType) -> bool:
    """Whether the schema has text that is not known to stay on one line."""
    return any(isinstance(f.dataType, T.StringType) and f.name not in ONE_LINE for f in schema.fields)


# What a stretch of lines is: a whole record, the rest of one that began in an
# earlier split (with or without its end), or one that goes on in the next split.
WHOLE, REST, MIDDLE, BEGIN = range(4)


def _split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, line): lines of plain splits, in file order within each split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("value").alias("line"),
    )


def _splits_inside_quotes(lines: DataFrame) -> DataFrame:
    """(file, split, inside): the splits whose first line stands inside quotes.

    A line with an odd number of quotes opens or closes a quoted value, so the
    parities of all earlier splits decide; one row per split leaves the tasks.
    """
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    odd = lines.groupBy("file", "split").agg((F.sum(quotes) % 2).alias("odd"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1
    return odd.select("file", "split", inside.alias("inside")).where("inside")


def _record_joiner() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Nested, so that workers need no copy of this package."""
    whole, rest, middle, begin = WHOLE, REST, MIDDLE, BEGIN

    def stretches(file: int, split: int, kinds: pa.Array, first: list[bool], records: pa.Array) -> pa.RecordBatch:
        n = len(kinds)
        columns = [pa.array([file] * n, pa.int64()), pa.array([split] * n, pa.int64()), kinds, pa.array(first, pa.bool_())]
        return pa.record_batch([*columns, records.cast(pa.string())], ["file", "split", "kind", "first", "record"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stretches (file, split, kind, first, record) from lines that come split by split.

        Lines are joined to records where the number of quotes so far is even. Only
        the record that is open at the end of a batch is kept between batches.
        """
        here, inside, began, first, held = None, False, True, False, []

        def row(kind: int, record: str) -> pa.RecordBatch:
            return stretches(*here, pa.array([kind], pa.int8()), [first], pa.array([record], pa.string()))

        for batch in batches:
            file, split = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((np.diff(file) != 0) | (np.diff(split) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if here != (int(file[a]), int(split[a])):
                    if held:
                        yield row(begin if began else middle, "\n".join(held))
                    here, held = (int(file[a]), int(split[a])), []
                    inside = began = batch.column(3)[a].as_py()
                    began, first = not began, here[1] == 0
                lines = batch.column(2).slice(a, b - a)
                odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2
                before = (np.cumsum(odd) - odd + inside) % 2
                inside = bool((before[-1] + odd[-1]) % 2)
                starts = np.flatnonzero(before == 0)
                cut = int(starts[0]) if len(starts) else len(lines)
                if held or not began:
                    held += lines.slice(0, cut).to_pylist()
                    if len(starts) or not inside:
                        yield row(whole if began else rest, "\n".join(held))
                        held, began, first = [], True, False
                if len(starts):
                    stop = int(starts[-1]) if inside else len(lines)
                    if stop > cut:
                        offsets = np.append(starts[starts < stop], stop) - cut
                        joined = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines.slice(cut, stop - cut))
                        flags = [first] + [False] * (len(offsets) - 2)
                        kinds = pa.array(np.zeros(len(flags), np.int8))
                        yield stretches(*here, kinds, flags, pc.binary_join(joined, "\n"))
                        first = False
                    if inside:
                        held = lines.slice(stop).to_pylist()
        if held:
            yield row(begin if began else middle, "\n".join(held))

    return records


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the records of quoted CSV files without their headers, read by plain splits.

    Values may hold line breaks inside quotes, wherever splits end. One pass
    counts quotes by split; which splits start inside quotes is all that the
    others are told. Records that lie in one split are put together there and
    not shuffled; the pieces of those that cross a split's end, two a split, are
    found by a pass of their own and joined by file.

    Quotes have to stand around values and be doubled inside, as CSV defines and
    databases write it. A file that ends inside quotes fails the query.
    """
    lines = _split_lines(spark, path)
    # At most 17 bytes for every split of 128 MB: 14 MB for 100 TB.
    known = lines.join(F.broadcast(_splits_inside_quotes(lines)), ["file", "split"], "left")
    known = known.select("file", "split", "line", F.coalesce("inside", F.lit(False)).alias("inside"))
    found = known.mapInArrow(_record_joiner(), "file long, split long, kind byte, first boolean, record string")
    whole = found.where((F.col("kind") == WHOLE) & ~F.col("first")).select("record")

    pieces = found.where(F.col("kind") != WHOLE)
    # Rest or middle of an earlier record, before one that begins in the same split.
    order = Window.partitionBy("file").orderBy("split", "kind")
    number = F.sum(F.when(F.col("kind") == BEGIN, 1).otherwise(0)).over(order)
    piece = F.struct("split", "kind", "first", "record")
    joined = pieces.withColumn("number", number).groupBy("file", "number")
    joined = joined.agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    kinds = F.col("pieces.kind")
    closed = (F.get(kinds, F.lit(0)) == BEGIN) & (F.element_at(kinds, -1) == REST)
    record = F.when(closed, F.array_join("pieces.record", "\n")).otherwise(
        F.raise_error(F.lit("a quoted value is not closed"))
    )
    crossing = joined.where(~(closed & F.get(F.col("pieces.first"), F.lit(0)))).select(record.alias("record"))
    record = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return whole.union(crossing).select(record.alias("record")).where("record <> ''")


def load_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool | None = None) -> DataFrame:
    """Read CSV by column position; any row that does not fit fails the load.

    Files are read by splits, however large one is. Where the schema has text
    that may hold line breaks inside quotes, records are put together by
    ``csv_records``; files without other text than ids and vocabularies are read
    line by line, and a line break in one of those fails the load. ``multiline``
    chooses Spark's own reader instead: True takes one task per file, False
    expects no line break inside quotes.
    """
    options = {**CSV_OPTIONS, "mode": "FAILFAST"}
    if multiline is None and may_hold_line_breaks(schema):
        parsed = {k: v for k, v in options.items() if k not in ("header", "multiLine", "columnPruning")}
        # Parsed as a whole, so a record of another shape fails whichever columns are read.
        row = F.from_csv("record", schema.toDDL(), parsed)
        return csv_records(spark, path).select(row.alias("row")).select("row.*")
    options["multiLine"] = str(bool(multiline)).lower()
    return spark.read.schema(schema).options(**options).csv(path)


def write_snapshot(df: DataFrame, root: str, table: str, rows_per_file: int = 1_000_000) -> str:
    """Replace the table's snapshot folder; returns its path.

    Null is written as nothing and the empty string as ""; ``load_csv`` and the
    external tables keep them apart.
    """
    path = snapshot_path(root, table)
    df.write.mode("overwrite").options(**WRITE_OPTIONS).option("maxRecordsPerFile", rows_per_file).csv(path)
    return path
