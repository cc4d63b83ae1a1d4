"""Runs of words that repeat with a period: branching tandems in an enhanced suffix array."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc32_sql
from tidemark.llm.suffixes import pyramid, smaller_before, sort_suffixes

#: So many suffixes are checked at once; bounds a task's memory.
CHECKED = 2_000_000


def _branching_tandems(order: np.ndarray, rank: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every square whose two halves are followed by different words.

    Each place k of the array with lcp[k] > 0 parts an interval of common prefixes
    in two: the suffixes on its left and right share lcp[k] words and no more.
    For every suffix i of the smaller part, i + lcp[k] or i - lcp[k] in the other
    part (its place is in the inverse array) means that a square starts at the
    earlier of the two. The smaller parts of all intervals hold n log n suffixes.
    """
    n = len(order)
    at = np.flatnonzero(lcp > 0)
    closed = np.append(lcp, np.int32(0))
    before = smaller_before(pyramid(closed), at, strict=True)
    after = n - smaller_before(pyramid(np.ascontiguousarray(closed[::-1])), n - at, strict=False)
    left = at - before <= after - at
    low = np.where(left, before, at)
    size = np.where(left, at - before, after - at)
    starts, periods = [], []
    ends = np.cumsum(size)
    begin = 0
    while begin < len(at):
        done = int(ends[begin - 1]) if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, done + CHECKED, side="right")))
        part = slice(begin, stop)
        node = np.repeat(np.arange(begin, stop), size[part])
        slot = np.arange(len(node)) + np.repeat(low[part] - (ends[part] - size[part] - done), size[part])
        i, depth = order[slot], lcp[at[node]].astype(np.int64)
        other = np.where(left[node], at[node], before[node])
        beyond = np.where(left[node], after[node], at[node])
        for j, tail in ((i, i + depth), (i - depth, i - depth)):
            place = rank[np.clip(tail, 0, n - 1)]
            found = (tail >= 0) & (tail < n) & (place >= other) & (place < beyond)
            starts.append(j[found])
            periods.append(depth[found])
        begin = stop
    none = [np.zeros(0, np.int64)]
    return np.concatenate(starts or none), np.concatenate(periods or none)


def _rotations(words: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How often each square can be rotated to the left: matching words before its halves."""
    turned = np.zeros(len(start), np.int64)
    todo = np.arange(len(start))
    for _ in range(32):
        at = start[todo] - turned[todo] - 1
        todo = todo[words[at] == words[at + period[todo]]]
        turned[todo] += 1
        if not len(todo):
            return turned
    for k in todo.tolist():
        end, p, width = int(start[k] - turned[k]), int(period[k]), 64
        while True:
            width = min(2 * width, end)
            other = np.flatnonzero(words[end - width : end] != words[end - width + p : end + p])
            if len(other) or not width:
                turned[k] = start[k] - (end - width + int(other[-1]) + 1 if len(other) else end)
                break
            end -= width
    return turned


def find_runs(ids: list[np.ndarray], min_words: int) -> tuple[np.ndarray, ...]:
    """(document, start, length, period) of all runs, by document, start and period.

    ``ids`` are word numbers from 1, one array a document. A run holds one
    branching square of its period, the last one; rotating that to the left finds
    the start. Squares of multiples of the period end at the same word and go
    with it, smallest period first.
    """
    sizes = np.array([len(x) for x in ids], np.int64)
    doc = np.repeat(np.arange(len(ids)), sizes + 1)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    words = np.zeros(len(doc), np.int64)
    inside = np.ones(len(doc), bool)
    inside[starts + sizes] = False
    if inside.any():
        # A word of another document is another symbol.
        flat = np.concatenate(ids).astype(np.int64)
        words[inside] = doc[inside] * (int(flat.max()) + 1) + flat
    order, rank, lcp = sort_suffixes(words)
    start, period = _branching_tandems(order, rank, lcp)
    # Separators match nothing, not even each other.
    words[~inside] = -1 - np.arange(len(ids))
    end = start + 2 * period
    by = np.lexsort((period, end))
    start, period, end = start[by], period[by], end[by]
    found = []
    while len(start):
        first = np.ones(len(start), bool)
        first[1:] = np.diff(end) != 0
        least = np.flatnonzero(first)
        from_ = start[least] - _rotations(words, start[least], period[least])
        long = end[least] - from_ >= np.maximum(min_words, 2 * period[least])
        found.append(np.stack([from_, end[least] - from_, period[least]])[:, long])
        group = np.cumsum(first) - 1
        rest = (period % period[least][group] != 0) | (start < from_[group])
        start, period, end = start[rest], period[rest], end[rest]
    from_, length, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    by = np.lexsort((period, from_))
    from_, length, period = from_[by], length[by], period[by]
    return doc[from_], from_ - starts[doc[from_]], length, period


def _scan(min_words: int, batch_words: int):
    def texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[list[bytes]]]]:
        """Words of the batch's rows, in groups of about ``batch_words`` words."""
        start, held, size = 0, [], 0
        for row, value in enumerate(batch.column(1)):
            held.append((value.as_py() or b"").split())
            size += len(held[-1])
            if size >= batch_words or row == batch.num_rows - 1:
                yield start, held
                start, held, size = row + 1, [], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, held in texts(batch):
                numbers: dict[bytes, int] = {}
                ids = [
                    np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in words), np.int64, len(words))
                    for words in held
                ]
                doc, start, length, period = find_runs(ids, min_words)
                edges = np.searchsorted(doc, np.arange(len(held) + 1))
                kept = [
                    _collapse(words, start[a:b], length[a:b], period[a:b])
                    for words, a, b in zip(held, edges[:-1].tolist(), edges[1:].tolist())
                ]
                spans = pa.StructArray.from_arrays(
                    [pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"]
                )
                yield pa.record_batch(
                    [
                        batch.column(0).slice(begin, len(held)),
                        pa.array([len(words) for words in held], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(edges, pa.int32()), spans),
                        pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def _collapse(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words outside all runs but for each run's first period, joined by blanks."""
    if not len(start):
        return b" ".join(words)
    edge = np.bincount(start + period, minlength=len(words) + 1) - np.bincount(start + length, minlength=len(words) + 1)
    gone = np.cumsum(edge)[: len(words)] > 0
    return b" ".join([w for w, out in zip(words, gone.tolist()) if not out])


def periodic_runs(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = 12,
    batch_words: int = 200_000,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of ``docs``.

    Words are cut at ASCII white space and numbered from 0. A run is a stretch of
    words with smallest period q, at least ``max(min_words, 2 * q)`` long, that no
    neighbouring word extends with that period. ``runs`` holds start, length and
    period of all, by start and period. ``collapsed`` is the text (UTF-8 bytes)
    without the words that any run has after its first period, joined by blanks.

    A narrow plan: documents share a suffix array in groups of about
    ``batch_words`` words, which bounds memory but for one longer text, whose
    arrays take about 100 bytes a word. Null and empty texts have no words, no
    runs and an empty ``collapsed``. Rows stay one to one, also for null or
    repeated ids; other columns are ignored.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    runs = "array<struct<start:bigint,length:bigint,period:bigint>>"
    return source.mapInArrow(_scan(min_words, batch_words), f"doc_id {kind}, n_words long, runs {runs}, collapsed binary")


def cycled_tails(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with a planted run at the end of about a tenth of the texts.

    With h the crc32 of the id as text and g = h / 10: where h is divisible by 10,
    each word i >= a is replaced by the original word a + (i - a) % p, with
    a = g % n and p = 1 + (n - a) / (3 + g % 8), n being the number of words.
    Texts without words or id, and all others, stay as they are.
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0)))
    g, n = F.floor(h / 10), F.size("w").cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), words.alias("w"))
    source = source.withColumn("cut", F.when(F.size("w") > 0, F.struct(a.alias("a"), p.alias("p"))))
    cycled = F.expr("array_join(transform(w, (x, i) -> if(i < cut.a, x, w[int(cut.a + (i - cut.a) % cut.p)])), ' ')")
    return source.select("doc_id", F.when(F.col("cut").isNotNull(), cycled).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Per document: number of runs, the longest one, and digests of all runs and of the collapsed text."""
    # Of the longest the first, then that of the smallest period, as runs are in that order.
    most = F.expr("array_max(transform(runs, r -> r.length))")
    longest = F.expr("get(filter(runs, r -> r.length = most), 0)")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, chr(10))), '')")
    return found.withColumn("most", most).withColumn("top", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


RUNS_SQL = rf"""
WITH raw AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         {crc32_sql("CAST(doc_id AS VARCHAR)")} AS h
  FROM documents
), cut AS (
  SELECT *, (h // 10) % len(w) AS a, 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) AS p FROM raw
), docs AS (
  SELECT r, doc_id, CASE WHEN h % 10 = 0 AND len(w) > 0
    THEN list_transform(range(len(w)), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
  FROM cut
), grams AS (
  -- A run has at least max(6, period) pairs of equal words one period apart.
  SELECT r, i, array_to_string(w[i : i + 5], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 4)) AS i FROM docs)
), islands AS (
  SELECT a.r, a.i, b.i - a.i AS d, a.i - row_number() OVER (PARTITION BY a.r, b.i - a.i ORDER BY a.i) AS island
  FROM grams a JOIN grams b ON a.r = b.r AND a.g = b.g AND a.i < b.i
), stretches AS (
  SELECT r, min(i) - 1 AS start, count(*) + 5 + d AS length, d AS period FROM islands GROUP BY r, d, island
  HAVING count(*) + 5 + d >= greatest(12, 2 * d)
), runs AS (
  SELECT r, start, length, min(period) AS period FROM stretches GROUP BY r, start, length
), per_doc AS (
  SELECT r, count(*) AS n_runs,
         list({{'s': start, 'l': length, 'p': period}} ORDER BY length DESC, start, period)[1] AS top,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY r
), gone AS (
  SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY i) AS text
  FROM (SELECT r, unnest(w) AS x, unnest(range(len(w))) AS i FROM docs) ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.l AS length, top.p AS period,
       1000 * top.l // top.p AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(text, '')) AS collapsed_sha256
FROM docs LEFT JOIN per_doc USING (r) LEFT JOIN kept USING (r)
"""
