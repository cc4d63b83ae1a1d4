"""Finds and cuts benchmark passages, with one FM-index per training shard."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import WORD_BYTES, staged, unused
from tidemark.llm.suffixes import FMIndex

WINDOW = 10


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


class Phrases:
    """Distinct windows of benchmark items, by length, as word numbers from 1."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                found.setdefault(tuple(words[i : i + size]), set()).add(item)
        by_size: dict[int, list[tuple[int, ...]]] = {}
        for phrase in found:
            by_size.setdefault(len(phrase), []).append(phrase)
        self.sizes = {
            size: (np.array(rows, np.int64), [sorted(found[r]) for r in rows]) for size, rows in by_size.items()
        }


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[Phrases]:
    """The benchmark in blocks of at most ``block_words`` words, or one item."""
    held: list[tuple[str, str | None]] = []
    size = 0
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.col(text))
    for item, passage in rows.toLocalIterator():
        size += len(words_of(passage))
        if held and size > block_words:
            yield Phrases(held)
            held, size = [], len(words_of(passage))
        held.append((item, passage))
    yield Phrases(held)


def _candidates(ids: list[np.ndarray], shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of at least ``shortest`` benchmark words, a separator after each.

    A phrase consists of benchmark words, so it can stand nowhere else.
    Returns symbols, document and word number of every kept place.
    """
    sizes = np.array([len(x) for x in ids])
    doc = np.repeat(np.arange(len(ids)), sizes + 1)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    place = np.arange(len(doc)) - starts[doc]
    flat = np.zeros(len(doc), np.int64)
    flat[place < sizes[doc]] = np.concatenate(ids) if len(ids) else []
    known = np.concatenate([[0], (flat > 0).astype(np.int8), [0]])
    begin, end = np.flatnonzero(np.diff(known) == 1), np.flatnonzero(np.diff(known) == -1)
    long = end - begin >= shortest
    begin, end = begin[long], end[long]
    # Every document ends with a separator, so there is one after every run.
    size = end - begin + 1
    at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    symbols = flat[at]
    symbols[np.cumsum(size) - 1] = 0
    return symbols, doc[at], place[at]


def _search(symbols: np.ndarray, phrases: Phrases, shard: int):
    """Yields (positions, phrase numbers, size) of all occurrences, shard by shard.

    A shard reaches over its end by the longest phrase, so cuts lose nothing.
    """
    longest = max(phrases.sizes, default=0)
    for start in range(0, len(symbols), shard):
        index = FMIndex(np.append(symbols[start : start + shard + longest], 0))
        for size, (rows, _) in phrases.sizes.items():
            lo, hi = index.search(rows)
            which = np.repeat(np.arange(len(rows)), hi - lo)
            ends = np.cumsum(hi - lo)
            at = index.locate(np.arange(len(which)) + np.repeat(lo - (ends - (hi - lo)), hi - lo))
            own = at < shard
            yield at[own] + start, which[own], size


def _find(phrases: Phrases, text_at: int, state_at: int, shard: int):
    shortest = min(phrases.sizes, default=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = phrases.vocabulary.get
        for batch in batches:
            ids, n_words = [], []
            for value in batch.column(text_at):
                words = words_of(value.as_py())
                n_words.append(len(words))
                ids.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
            spans = [list(map(tuple, zip(*[iter(x or ())] * 2))) for x in batch.column(state_at + 1).to_pylist()]
            items = [set(x or ()) for x in batch.column(state_at + 2).to_pylist()]
            symbols, doc, place = _candidates(ids, shortest)
            hit = np.zeros(len(symbols) + 1, np.int64)
            for at, which, size in _search(symbols, phrases, shard) if len(symbols) else ():
                np.add.at(hit, at, 1)
                np.add.at(hit, at + size, -1)
                names = phrases.sizes[size][1]
                for d, w in np.unique(np.stack([doc[at], which], 1), axis=0).tolist():
                    items[d].update(names[w])
            covered = np.concatenate([[0], (np.cumsum(hit[:-1]) > 0).astype(np.int8), [0]])
            begin, end = np.flatnonzero(np.diff(covered) == 1), np.flatnonzero(np.diff(covered) == -1)
            for b, e in zip(begin.tolist(), end.tolist()):
                spans[doc[b]].append((int(place[b]), int(place[e - 1]) + 1))
            state = [
                pa.array(n_words, pa.int64()),
                pa.array([_merged(x) for x in spans], pa.list_(pa.int64())),
                pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            ]
            kept = [batch.column(i) for i in range(state_at)]
            yield pa.record_batch(kept + state, names=batch.schema.names)

    return run


def _merged(spans: list[tuple[int, int]]) -> list[int]:
    """Sorted spans without overlap, as a flat list of starts and ends."""
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_words: int = 500_000,
    shard: int = 500_000,
) -> DataFrame:
    """``docs`` plus n_words, spans (flat word starts and ends) and items.

    A window is ten consecutive words of an item, or the whole item if shorter.
    All words inside any occurrence of a window are covered by ``spans``, merged
    and in order. ``items`` are the ids, as sorted strings, of items with
    occurring windows.

    Each task cuts its documents into shards of at most ``shard`` words, builds
    an FM-index of each and searches all windows in it. Only stretches of words
    that occur in the benchmark enter the index. The benchmark is the query set:
    it is sent to the tasks in blocks of ``block_words`` words, one pass each.
    A pass is written before the next block is read, so the driver and the
    tasks hold one block at a time.

    Null and empty texts have no words; items without words match nothing; a
    null item id reads as the empty string, and rows that repeat an item id are
    one item. Rows stay as they are otherwise; new columns whose name is taken
    get an underscore.
    """
    names = unused(docs, "n_words", "spans", "items")
    kinds = [T.LongType(), T.ArrayType(T.LongType()), T.ArrayType(T.StringType())]
    out = docs.withColumns({n: F.lit(None).cast(k) for n, k in zip(names, kinds)})
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema])
    at, state_at = docs.columns.index(text), len(docs.columns)
    for n, phrases in enumerate(item_blocks(benchmark, item_id, item_text, block_words)):
        if n:
            out = staged(out, "benchmark-pass")
        out = out.mapInArrow(_find(phrases, at, state_at, shard), schema)
    return out


#: The words of ``words_of`` in text whose A-Z are still there.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut_words(text: str | None, spans: list[int] | None) -> str | None:
    """``text`` without the words in ``spans`` and what stands between them."""
    if not text or not spans:
        return text
    places = [m.span() for m in _WORD.finditer(text)]
    kept, last = [], 0
    for start, end in zip(spans[::2], spans[1::2]):
        kept.append(text[last : places[start][0]])
        last = places[end - 1][1]
    return "".join(kept) + text[last:]


def remove_passages(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """``docs`` with every passage found by ``find_passages`` cut out of its text.

    Columns stay; documents without a passage are unchanged, and a document that
    is nothing but passages keeps what stands around its words.
    """
    found = find_passages(docs, benchmark, text=text, **options)
    names, at, spans_at = docs.columns, docs.columns.index(text), len(docs.columns) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(spans_at)
            cut = [cut_words(t.as_py(), s.as_py()) for t, s in zip(batch.column(at), spans)]
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(cut, pa.string())
            yield pa.record_batch(columns, names=names)

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    return found.mapInArrow(run, schema)


PASSAGES_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, w[i : i + least(10, len(w)) - 1] AS phrase
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), places AS (
  SELECT doc_id, w[i : i + size - 1] AS phrase, size, i
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc_words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), found AS (
  SELECT doc_id, item_id, i, p.size FROM places p JOIN windows v ON p.size = v.size AND p.phrase = v.phrase
), hits AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""
