"""Byte-level BPE encoding in overlapping chunks, and decoding."""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import staged, unused
from tidemark.llm.pretokens import character_spans, pattern_for, use_spans


def chunk_bounds(length: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Overlapping stretches [start, end) that cover a text of ``length``."""
    return [(s, min(length, s + chunk + overlap)) for s in range(0, max(length, 1), chunk)]


def pretoken_ends(part: str) -> np.ndarray:
    """Where the pre-tokens of a chunk end."""
    return np.cumsum(np.fromiter(map(len, pattern_for(part).findall(part)), np.int64))


def stitch(text: str, chunks: list[tuple[int, np.ndarray]], overlap: int) -> np.ndarray:
    """Ends of the pre-tokens of ``text`` from those of its chunks.

    ``chunks`` = (start, ends from there). A pre-token depends only on what
    follows its start, so once two chunks have a boundary in common they agree
    from there on. The last boundary of a chunk that was cut short, and the one
    before it, may be due to the cut and do not count. Where the overlap has no
    common boundary, text is matched on from the last sure one until it meets
    the next chunk's boundaries.
    """
    done = [np.zeros(1, np.int64)]
    match = pattern_for(text).match
    for k, (start, ends) in enumerate(chunks):
        own = np.concatenate([[start], start + ends])
        at = int(done[-1][-1])
        if k:
            while at < len(text) and not _in(own, at):
                at = match(text, at).end()
                done.append(np.array([at]))
        if k + 1 < len(chunks):
            own = own[:-2]
            stop = chunks[k + 1][0] + overlap // 2
            own = own[own <= stop]
        more = own[own > at]
        if len(more) and _in(own, at):
            done.append(more)
    return np.concatenate(done)[1:]


def _in(sorted_values: np.ndarray, x: int) -> bool:
    i = int(np.searchsorted(sorted_values, x))
    return i < len(sorted_values) and int(sorted_values[i]) == x


class Encoder:
    """Encodes by a rank file; pieces seen before come from a bounded cache."""

    def __init__(self, name: str, cache_size: int = 200_000):
        with open(public_tokenizers.path(name), "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.table = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.table[rank] = token
        self.cache: dict[str, bytes] = {}
        self.cache_size = cache_size

    def piece(self, raw: bytes) -> list[int]:
        """Ids of one pre-token: lowest-rank neighbours are joined first."""
        get, never = self.ranks.get, len(self.table)
        if (whole := get(raw)) is not None:
            return [whole]
        if len(raw) > 64:
            return self._long_piece(raw)
        # Part i is raw[cuts[i] : cuts[i + 1]]; costs[i] is the rank of parts i and i + 1 together.
        cuts = list(range(len(raw) + 1))
        costs = [get(raw[i : i + 2], never) for i in range(len(raw) - 1)]
        while costs and (best := min(costs)) < never:
            i = costs.index(best)
            del cuts[i + 1], costs[i]
            if i:
                costs[i - 1] = get(raw[cuts[i - 1] : cuts[i + 1]], never)
            if i < len(costs):
                costs[i] = get(raw[cuts[i] : cuts[i + 2]], never)
        return [self.ranks[raw[a:b]] for a, b in zip(cuts, cuts[1:])]

    def _long_piece(self, raw: bytes) -> list[int]:
        """As ``piece``, with a heap, so long runs stay near linear."""
        n = len(raw)
        end = list(range(1, n + 1))
        back = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := self.ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            # Stale if i was swallowed, or either side has grown since.
            if j <= i or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, -1
            if stop < n:
                back[stop] = i
                if (r := self.ranks.get(raw[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            h = back[i]
            if h >= 0 and (r := self.ranks.get(raw[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[raw[i : end[i]]])
            i = end[i]
        return out

    def _new(self, piece: str) -> bytes:
        raw = piece.encode("utf-8", "surrogatepass")
        found = np.array(self.piece(raw), "<u4").tobytes()
        if len(self.cache) >= self.cache_size:
            self.cache.clear()
        if len(raw) <= 256:
            self.cache[piece] = found
        return found

    def packed(self, pieces: list[str]) -> list[bytes]:
        """Ids of each pre-token, packed as little-endian unsigned 32-bit integers."""
        known = list(map(self.cache.get, pieces))
        if None in known:
            known = [self._new(p) if k is None else k for p, k in zip(pieces, known)]
        return known

    def pieces(self, pieces: list[str]) -> bytes:
        """Ids of pre-tokens, one after another."""
        return b"".join(self.packed(pieces))

    def decode(self, packed: bytes) -> bytes:
        """The raw bytes of packed ids, one after another."""
        return b"".join(map(self.table.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@functools.cache
def _encoder(name: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(name)


def encode_text(encoder: Encoder, text: str, chunk: int, overlap: int) -> bytes:
    """Packed ids of one text, through its chunks if it has more than one."""
    if len(text) <= chunk + overlap:
        return encoder.pieces(pattern_for(text).findall(text))
    chunks = [(s, pretoken_ends(text[s:e])) for s, e in chunk_bounds(len(text), chunk, overlap)]
    return _encode_stitched(encoder, text, chunks, overlap)


def _encode_stitched(encoder: Encoder, text: str, chunks: list[tuple[int, np.ndarray]], overlap: int) -> bytes:
    ends = stitch(text, chunks, overlap).tolist()
    return encoder.pieces([text[a:b] for a, b in zip([0, *ends], ends)])


def _encode_in_place(
    docs: DataFrame, text: str, ids: str, tokenizer: str, chunk: int, overlap: int
) -> DataFrame:
    """``docs`` with each text encoded where it stands."""
    at = docs.columns.index(text)
    fields = [T.StructField(f.name, f.dataType, True) for f in docs.schema]
    fields[at] = T.StructField(ids, T.BinaryType(), True)

    spans = character_spans()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_spans(spans)
        encoder = _encoder(tokenizer)
        for batch in batches:
            packed = [encode_text(encoder, t.as_py() or "", chunk, overlap) for t in batch.column(at)]
            columns = list(batch.columns)
            columns[at] = pa.array(packed, pa.binary())
            yield pa.record_batch(columns, names=[f.name for f in fields])
        encoder.cache.clear()  # idle workers hold no pieces

    return docs.mapInArrow(run, T.StructType(fields))


_PART = pa.schema({"key": pa.string(), "number": pa.int32(), "start": pa.int64(), "last": pa.bool_(), "part": pa.string()})


def _cut(part: int, overlap: int):
    """Rows (key, text) into rows of overlapping parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, whole in zip(*(batch.column(c) for c in ("key", "text"))):
                key, whole = key.as_py(), whole.as_py()
                for number, (start, end) in enumerate(chunk_bounds(len(whole), part, overlap)):
                    row = [key, number, start, start + part >= len(whole), whole[start:end]]
                    yield pa.record_batch([pa.array([x], f.type) for x, f in zip(row, _PART)], schema=_PART)

    return run


_ENCODED = pa.schema(
    {
        "key": pa.string(),
        "number": pa.int32(),
        "last": pa.bool_(),
        "head": pa.list_(pa.int64()),
        "head_at": pa.list_(pa.int32()),
        "tail": pa.list_(pa.int64()),
        "tail_at": pa.list_(pa.int32()),
        "size": pa.int32(),
        "ids": pa.binary(),
    }
)


def _encode_part(encoder: Encoder, start: int, last: bool, text: str, part: int, overlap: int) -> list:
    """head, head_at, tail, tail_at, size, ids of one part.

    ``head`` and ``tail`` are the boundaries that the overlaps with the part
    before and after it have, counted from the text's start; ``head_at`` and
    ``tail_at`` say how many ids precede them.
    """
    pieces = pattern_for(text).findall(text)
    packed = encoder.packed(pieces)
    ends = start + np.concatenate([[0], np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))])
    counts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed)) // 4)])
    # As in ``stitch``, the last two boundaries may be due to the cut.
    sure = slice(0, len(ends) if last else max(0, len(ends) - 2))
    found = []
    for low in (start, start + part):
        near = (ends[sure] >= low) & (ends[sure] <= low + overlap)
        found += [ends[sure][near].tolist(), counts[sure][near].tolist()]
    return [*found, int(counts[-1]), b"".join(packed)]


def _encode_parts(tokenizer: str, part: int, overlap: int):
    spans = character_spans()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_spans(spans)
        encoder = _encoder(tokenizer)
        for batch in batches:
            for row in batch.to_pylist():
                found = _encode_part(encoder, row["start"], row["last"], row["part"], part, overlap)
                values = [row["key"], row["number"], row["last"], *found]
                yield pa.record_batch([pa.array([x], f.type) for x, f in zip(values, _ENCODED)], schema=_ENCODED)
        encoder.cache.clear()

    return run


def _spark_schema(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.bool_(): "boolean", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(
        f"{f.name} {f'array<{names[f.type.value_type]}>' if pa.types.is_list(f.type) else names[f.type]}" for f in schema
    )


def _encode_spread(texts: DataFrame, tokenizer: str, part: int, overlap: int) -> DataFrame:
    """(key, ids) of long texts (key, text); their parts are encoded by different tasks.

    Copies of a text share a key and are reduced to one before parts are moved.
    A part begins to count at the first boundary that it has in common with the
    part before it, and ends where the next one begins. Ids are null where two
    parts have no boundary in common.
    """
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = texts.mapInArrow(_cut(part, overlap), _spark_schema(_PART))
    parts = parts.groupBy("key", "number").agg(*(F.first(c).alias(c) for c in ("start", "last", "part")))
    # A given number of partitions, as parts are small on disk and much work.
    parts = parts.repartition(tasks, "key", "number").select(*_PART.names)
    encoded = parts.mapInArrow(_encode_parts(tokenizer, part, overlap), _spark_schema(_ENCODED))

    along = Window.partitionBy("key").orderBy("number")
    met = {
        "entry": F.array_min(F.array_intersect(F.lag("tail").over(along), "head")),
        "leave": F.array_min(F.array_intersect("tail", F.lead("head").over(along))),
    }
    placed = encoded.withColumns(met)
    first = F.when(F.col("number") == 0, 0).otherwise(F.get("head_at", (F.array_position("head", F.col("entry")) - 1).cast("int")))
    stop = F.when(F.col("last"), F.col("size")).otherwise(F.get("tail_at", (F.array_position("tail", F.col("leave")) - 1).cast("int")))
    own = placed.select("key", "number", first.alias("first"), stop.alias("stop"), "ids")
    own = own.withColumn("own", F.expr("substring(ids, first * 4 + 1, (stop - first) * 4)"))
    joined = F.when(F.count("own") == F.count("*"), F.expr("listagg(own) WITHIN GROUP (ORDER BY number)"))
    return own.groupBy("key").agg(joined.alias("ids"))


def encode_documents(
    docs: DataFrame,
    *,
    text: str = "text",
    ids: str = "ids",
    tokenizer: str = "byte_bpe_50k.tiktoken",
    chunk: int = 16_384,
    overlap: int = 512,
    spread_bytes: int = 4 << 20,
    part: int = 1 << 20,
    part_overlap: int = 8_192,
) -> DataFrame:
    """``docs`` with the text replaced by ``ids``: packed 32-bit token ids.

    Texts are cut into chunks of ``chunk`` characters that overlap by
    ``overlap``; chunks are matched against the pre-token pattern on their own
    and stitched where their boundaries meet, and the pieces between boundaries
    are encoded. The result does not depend on the sizes.

    Texts of up to ``spread_bytes`` are encoded where they stand. Longer ones are
    cut into parts of ``part`` characters with ``part_overlap`` more, which
    different tasks pre-tokenise and encode; the parts are stitched by text, copies of
    a text once. Their ids are written below the scratch folder when this is
    called. A text whose parts have no boundary in common somewhere, such as a word longer
    than the overlap, is encoded where it stands too.

    A null text counts as empty and has no ids. Other columns pass through.
    """
    if part < 2 * part_overlap:
        raise ValueError("parts must be at least twice as long as their overlap")
    place = (text, ids, tokenizer, chunk, overlap)
    is_long = F.coalesce(F.octet_length(text) > spread_bytes, F.lit(False))
    key, found = unused(docs, "text_key", "text_ids")
    long = docs.where(is_long).withColumn(key, F.sha2(F.col(text), 256))
    texts = long.select(F.col(key).alias("key"), F.col(text).alias("text"))
    whole = staged(_encode_spread(texts, tokenizer, part, part_overlap), "bpe-long")
    if whole.isEmpty():
        return _encode_in_place(docs, *place)

    whole = whole.select(F.col("key").alias(key), F.col("ids").alias(found))
    unmet = long.join(whole.where(F.col(found).isNull()).select(key), key, "left_semi").select(*docs.columns)
    stitched = long.drop(text).join(whole.where(F.col(found).isNotNull()), key)
    stitched = stitched.select(*(F.col(found).alias(ids) if c == text else F.col(c) for c in docs.columns))
    return _encode_in_place(docs.where(~is_long).union(unmet), *place).union(stitched)


def decode_documents(
    encoded: DataFrame, *, ids: str = "ids", raw: str = "raw", tokenizer: str = "byte_bpe_50k.tiktoken"
) -> DataFrame:
    """``encoded`` with packed ids replaced by ``raw``, the bytes they stand for.

    Null ids decode to no bytes. Other columns pass through.
    """
    at = encoded.columns.index(ids)
    fields = [T.StructField(f.name, f.dataType, True) for f in encoded.schema]
    fields[at] = T.StructField(raw, T.BinaryType(), True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _encoder(tokenizer).decode
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([decode(x.as_py() or b"") for x in batch.column(at)], pa.binary())
            yield pa.record_batch(columns, names=[f.name for f in fields])

    return encoded.mapInArrow(run, T.StructType(fields))


def encoding_digests(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of ``docs``."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    encoded = encode_documents(source, **options)
    digested = encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        "ids",
    )
    decoded = decode_documents(digested)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("raw", 256).alias("decoded_sha256"))
