"""Token counts by byte-pair merging, without producing tokens."""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pretokens import character_spans, pattern_for, use_spans


def count_merges(piece: bytes, ranks: dict[tuple[bytes, bytes], int]) -> int:
    """How many merges byte-pair encoding does on ``piece``.

    Symbols form a linked list and adjacent pairs a heap by (rank, place). The
    lowest pair is merged until no pair has a rank; entries whose symbols have
    changed meanwhile are skipped. n symbols take O(n log n).
    """
    n = len(piece)
    get = ranks.get
    # A symbol is piece[i : end[i]]; end[i] is -1 once another has swallowed it.
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        if (rank := get((piece[i : i + 1], piece[i + 1 : i + 2]))) is not None:
            heap.append((rank, i, i + 1, i + 2))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        if end[i] != middle or end[middle] != stop:
            continue
        merges += 1
        end[i], end[middle] = stop, -1
        merged = piece[i:stop]
        if stop < n:
            before[stop] = i
            if (rank := get((merged, piece[stop : end[stop]]))) is not None:
                heapq.heappush(heap, (rank, i, stop, end[stop]))
        h = before[i]
        if h >= 0 and (rank := get((piece[h:i], merged))) is not None:
            heapq.heappush(heap, (rank, h, i, stop))
    return merges


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the other bytes take the
    characters from U+0100 on, in order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenCounter:
    """Counts the tokens of texts as a byte-level BPE file in JSON defines them."""

    def __init__(self, name: str, cache_size: int = 200_000):
        with open(public_tokenizers.path(name), encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        pairs = (tuple(bytes(map(letters.__getitem__, part)) for part in pair) for pair in spec["model"]["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.cache: dict[str, int] = {}
        self.cache_size = cache_size

    def _new(self, piece: str) -> int:
        raw = piece.encode("utf-8", "surrogatepass")
        found = len(raw) - count_merges(raw, self.ranks)
        if len(self.cache) >= self.cache_size:
            self.cache.clear()
        if len(raw) <= 256:
            self.cache[piece] = found
        return found

    def count(self, text: str | None) -> int:
        """Tokens of ``text``; the string of a special token inside it is one token."""
        parts, total = [text or ""], 0
        for special in self.special:
            cut = [p for part in parts for p in part.split(special)]
            total += len(cut) - len(parts)
            parts = cut
        for part in parts:
            pieces = pattern_for(part).findall(part)
            known = list(map(self.cache.get, pieces))
            if None in known:
                known = [self._new(p) if k is None else k for p, k in zip(pieces, known)]
            total += sum(known)
        return total


@functools.cache
def _counter(name: str) -> TokenCounter:
    """One counter per Python worker, so its pieces are merged once."""
    return TokenCounter(name)


def token_counts(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    limit: int = 1024,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    ``n_tokens`` is the number of bytes minus the number of merges, piece by
    piece; pieces seen before come from a bounded cache in each worker. A null
    text counts as empty: 0 bytes, 0 tokens. Ids may repeat or be null; other
    columns are ignored. The plan is narrow.
    """

    spans = character_spans()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_spans(spans)
        counter = _counter(tokenizer)
        count = counter.count
        for batch in batches:
            tokens = np.fromiter((count(t.as_py()) for t in batch.column(2)), np.int64, batch.num_rows)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(tokens)], ["doc_id", "n_bytes", "n_tokens"])
        counter.cache.clear()  # idle workers hold no pieces

    source = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    counted = source.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
