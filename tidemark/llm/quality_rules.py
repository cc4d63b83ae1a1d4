"""Quality rules on repetition, from suffix arrays of each document's words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.suffixes import sort_suffixes

SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\v\f\r"

COLUMNS = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "n_covered_words": "long",
    "longest_repeat": "long",
}


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in the union of spans [start, start + length)."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)[: n + 1]
    return np.cumsum(edge[:n]) > 0


def repetition(ids: list[np.ndarray], min_words: int, shingle: int = 3) -> tuple[np.ndarray, ...]:
    """Per document: words in repeated shingles, words in long repeats, longest repeat.

    ``ids`` are word numbers from 1. All documents share one suffix array, with
    a separator after each, and document-wise first words keep them apart. The
    longest prefix that a suffix shares with a neighbour is the longest
    common-prefix interval it lies in: the maximal repeated substring that
    starts there. The union of these spans is what repeats cover.
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
    order, _, lcp = sort_suffixes(words)
    repeat = np.empty(len(words), np.int64)
    repeat[order] = np.maximum(lcp, np.append(lcp[1:], 0))
    n = len(words)

    def per_doc(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags.astype(np.int64), starts)

    at = np.flatnonzero(repeat >= shingle)
    short = per_doc(_covered(at, np.full(len(at), shingle), n))
    at = np.flatnonzero(repeat >= min_words)
    return short, per_doc(_covered(at, repeat[at], n)), np.maximum.reduceat(repeat, starts)


def _measure(min_words: int, batch_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, ids, base = 0, 0, [], []
            numbers: dict[bytes, int] = {}
            for row, value in enumerate(batch.column(1)):
                raw = (value.as_py() or "").encode("utf-8", "surrogatepass")
                words = raw.split()
                ids.append(np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in words), np.int64, len(words)))
                lines = [x for x in raw.split(b"\n") if x.strip(_BLANKS)]
                bare = raw.translate(None, _BLANKS)
                n_chars = len(bare) if bare.isascii() else len(bare.translate(None, _TAILS))
                n_symbols = len(bare) - len(bare.translate(None, SYMBOLS))
                base.append((len(words), n_chars, n_symbols, len(lines) - len(set(lines))))
                held += len(words)
                if held >= batch_words or row == batch.num_rows - 1:
                    found = repetition(ids, min_words)
                    table = [*np.array(base, np.int64).T, *found]
                    yield pa.record_batch(
                        [batch.column(0).slice(start, len(ids)), *map(pa.array, table)], ["doc_id", *COLUMNS]
                    )
                    start, held, ids, base = row + 1, 0, [], []
                    numbers = {}

    return run


#: UTF-8 continuation bytes: without them one byte is left per code point.
_TAILS = bytes(range(0x80, 0xC0))


def quality_rules(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = 10,
    max_covered: float = 0.3,
    max_repeat: int = 100,
    batch_words: int = 200_000,
) -> DataFrame:
    """One row per document: measures, ``base_failed`` and ``kept``.

    Words are cut at ASCII white space. word_chars: code points in words;
    n_symbols: characters of ``#*$%&|<>``; n_dup_lines: lines with a word that
    equal an earlier line; n_repeat_words: words in 3-word windows that occur
    twice or more. base_failed: under 50 words, or over half of them in such
    windows. kept: the base holds, repeated passages of ``min_words`` words or
    more cover at most ``max_covered`` of the words (n_covered_words), and no
    passage of over ``max_repeat`` words repeats (longest_repeat).

    A narrow plan: documents share a suffix array in groups of about
    ``batch_words`` words, which bounds memory but for one longer text.
    Null and empty texts have no words and fail the base. Rows stay one to one,
    also for null or repeated ids; other columns are ignored.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{k} {v}" for k, v in COLUMNS.items())
    measured = source.mapInArrow(_measure(min_words, batch_words), schema)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    fine = (F.col("n_covered_words") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_repeat)
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & fine)


QUALITY_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), places AS (
  SELECT doc_id, size, i, count(*) OVER (PARTITION BY doc_id, size, array_to_string(w[i : i + size - 1], ' ')) AS n
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM words, (VALUES (3), (10), (101)) AS s(size) WHERE len(w) >= size)
), covered AS (
  SELECT doc_id, count(DISTINCT k) FILTER (WHERE size = 3) AS three,
         count(DISTINCT k) FILTER (WHERE size = 10) AS ten,
         count(*) FILTER (WHERE size = 101) AS long
  FROM (SELECT doc_id, size, unnest(range(i, i + size)) AS k FROM places WHERE n > 1) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(three, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(ten, 0) AS BIGINT) AS n_covered_words, coalesce(long, 0) > 0 AS long
  FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND n_covered_words <= 0.3 * n_words AND NOT long AS kept
FROM base
"""
