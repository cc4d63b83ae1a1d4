"""Exact top-k inner products: impact-ordered posting segments, scored level by level."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

#: The forward row of a shard sorts before its segments, which descend by impact.
FORWARD = 2**63 - 1
#: Queries that are scored at once; with the shard's size this bounds a task's memory.
BATCH = 256
#: Pairs that are rescored at once.
PAIRS = 100_000
#: Shares of a shard's squared components that may be unread when bounds are looked at.
LOOK_AT = (0.1, 0.02, 0.004)

INDEX = "shard int, level long, rows binary, ids binary, copies binary, body binary, width int"


def quantised(vectors: DataFrame, *, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(row, vec_id, v, copies): different rows with whole components, numbered; written once.

    Rows without id or vector, or whose vector has a component that is null or
    not finite, are left out.
    """
    numbers = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    found = vectors.where(F.col(vec_id).isNotNull() & usable).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(numbers, lambda x: F.floor(F.lit(float(scale)) * x)).alias("v"),
    )
    counted = found.groupBy("vec_id", "v").agg(F.count("*").alias("copies"))
    return staged(counted.withColumn("row", F.monotonically_increasing_id()), "quantised")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """List values as rows of a matrix, padded with zeros."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    line = np.repeat(np.arange(len(sizes)), sizes)
    out[line, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _build(table: pa.Table) -> pa.Table:
    """Index of one shard: its vectors, then one row per impact with the postings of that impact.

    A posting is vector * width + dimension, complemented if the component is negative.
    """
    sizes = [len(x) for x in table.column("v")]
    width = max(sizes, default=0)
    v = _matrix(table.column("v"), width)
    impact = np.abs(v).ravel()
    order = np.argsort(-impact, kind="stable")
    order = order[: np.count_nonzero(impact)]
    edges = np.flatnonzero(np.diff(impact[order], prepend=-1))
    postings = np.where(v.ravel()[order] < 0, ~order, order)
    shard = table.column("shard")[0].as_py()
    data = [x.to_numpy().astype(np.int64).tobytes() for x in map(table.column, ("row", "vec_id", "copies"))]
    out = [(shard, FORWARD, *data, v.tobytes(), width)]
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
        out.append((shard, int(impact[order[a]]), None, None, None, postings[a:b].tobytes(), width))
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4, pa.int32()]
    names = ["shard", "level", "rows", "ids", "copies", "body", "width"]
    return pa.table([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], names)


def build_index(rows: DataFrame, n_shards: int) -> DataFrame:
    """Impact-ordered index of ``rows``, in shards by hash, one row per shard and impact."""
    shard = F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int")
    sharded = rows.select(shard.alias("shard"), "row", "vec_id", "copies", "v")
    return staged(sharded.groupBy("shard").applyInArrow(_build, INDEX), "impact-index")


class Shard:
    """Vectors of a shard, and its segments added up to bands, impacts descending."""

    def __init__(self, forward: tuple, segments: list[tuple[int, bytes]]):
        rows, ids, copies, body, self.width = forward
        self.rows, self.ids, self.copies = (np.frombuffer(x, np.int64) for x in (rows, ids, copies))
        n = len(self.ids)
        self.vectors = np.frombuffer(body, np.int64).reshape(n, self.width)
        self.by_row = np.argsort(self.rows)
        squares = self.vectors.astype(np.float64) ** 2
        rest, left = squares.sum(axis=1), float(squares.sum())
        looks = [left * share for share in LOOK_AT]
        self.bands: list[tuple[np.ndarray, np.ndarray]] = []
        band = np.zeros(n * self.width)
        for place, (level, postings) in enumerate(segments):
            codes = np.frombuffer(postings, np.int64)
            at = np.where(codes < 0, ~codes, codes)
            band[at] = np.where(codes < 0, -float(level), float(level))
            left -= float(level) ** 2 * len(codes)
            rest = rest - float(level) ** 2 * np.bincount(at // self.width, minlength=n)
            last = place == len(segments) - 1
            if last or (looks and left <= looks[0]):
                rest = np.zeros(n) if last else np.maximum(rest, 0)
                self.bands.append((band.reshape(n, self.width).T.copy(), rest))
                band = np.zeros(n * self.width)
                looks = [look for look in looks if look < left]

    def columns(self, rows: np.ndarray) -> np.ndarray:
        """Place of each row number in this shard, -1 if it is not here."""
        slot = np.minimum(np.searchsorted(self.rows, rows, sorter=self.by_row), len(self.rows) - 1)
        found = self.by_row[slot]
        return np.where(self.rows[found] == rows, found, -1)

    def possible(self, vectors: np.ndarray, rows: np.ndarray, floor: np.ndarray, k: int):
        """Pairs (query, column) that may belong to the k best; all others are proven not to.

        Scores add up band by band. What is unread of a pair is at most the norm
        of the query's components that met no posting of the vector yet, times the
        norm of the vector's unread components. A query is done once few columns
        reach its k-th best score so far, or when all segments are read.
        """
        n, m = len(self.ids), len(vectors)
        width = min(self.width, vectors.shape[1])
        q = np.zeros((m, self.width))
        q[:, :width] = vectors[:, :width]
        square = q * q
        total = square.sum(axis=1)
        # What rounding may have cost.
        norms = np.sqrt(np.sum(self.vectors.astype(np.float64) ** 2, axis=1))
        slack = 2.0**-50 * (self.width + 2) * np.sqrt(total)[:, None] * norms[None, :]
        own = self.columns(rows)
        alone = (own >= 0) & (self.copies[own] == 1)
        alive = np.arange(m)
        score, met = np.zeros((m, n)), np.zeros((m, n))
        score[alone, own[alone]] = -np.inf
        # Without any segment all scores are zero.
        bands = self.bands or [(np.zeros((self.width, n)), np.zeros(n))]
        for place, (band, rest) in enumerate(bands):
            last = place == len(bands) - 1
            score += q[alive] @ band
            if last:
                bound = slack
            else:
                met += square[alive] @ (band != 0).astype(np.float64)
                bound = np.sqrt(np.maximum(total[alive, None] * (1 + 2.0**-40) - met, 0) * rest[None, :]) + slack
            least = floor[alive]
            if n > k:
                low = np.partition(score - bound, n - k, axis=1)[:, n - k]
                least = np.maximum(least, low)
            reach = score + bound >= least[:, None]
            done = reach.sum(axis=1) <= max(4 * k, n // 32) if not last else np.ones(len(alive), bool)
            line, column = np.nonzero(reach[done])
            yield alive[done][line], column
            alive, score, met, slack = alive[~done], score[~done], met[~done], slack[~done]
            if not len(alive):
                return


class Block:
    """Queries and the best candidates that were found for them so far."""

    def __init__(self, k: int):
        self.k = k
        self.queries: list[tuple[int, int, int, list[int]]] = []

    def begin(self) -> None:
        self.rows, self.ids, self.copies = (np.array([q[i] for q in self.queries], np.int64) for i in range(3))
        lists = pa.chunked_array([pa.array([q[3] for q in self.queries], pa.list_(pa.int64()))])
        self.vectors = _matrix(lists, max((len(q[3]) for q in self.queries), default=0))
        self.floor = np.full(len(self.rows), -np.inf)
        # Query, score, id and copies of the candidates.
        self.best = np.zeros((4, 0), np.int64)

    def search(self, shard: Shard) -> None:
        for a in range(0, len(self.rows), BATCH):
            part = slice(a, a + BATCH)
            for line, column in shard.possible(self.vectors[part], self.rows[part], self.floor[part], self.k):
                self._rescore(shard, line + a, column)

    def _rescore(self, shard: Shard, line: np.ndarray, column: np.ndarray) -> None:
        width = min(shard.width, self.vectors.shape[1])
        found = [self.best]
        for b in range(0, len(line), PAIRS):
            at, other = line[b : b + PAIRS], column[b : b + PAIRS]
            score = (self.vectors[at, :width] * shard.vectors[other, :width]).sum(axis=1)
            copies = shard.copies[other] - (shard.rows[other] == self.rows[at])
            found.append(np.stack([at, score, shard.ids[other], np.minimum(copies, self.k)])[:, copies > 0])
        every = np.concatenate(found, axis=1)
        every = every[:, np.lexsort((every[2], -every[1], every[0]))]
        query, copies = every[0], every[3]
        so_far = np.cumsum(copies) - copies
        begin = np.searchsorted(query, query)
        self.best = every[:, so_far - so_far[begin] < self.k]
        query, score, _, copies = self.best
        full = np.bincount(query, copies, minlength=len(self.rows)) >= self.k
        last = np.searchsorted(query, np.arange(len(self.rows)), side="right") - 1
        self.floor[full] = score[last[full]]

    def results(self) -> pa.RecordBatch:
        query, score, ids, copies = self.best
        columns = [self.rows[query], self.ids[query], self.copies[query], ids, score, copies]
        return pa.record_batch([pa.array(x, pa.int64()) for x in columns], FOUND)


FOUND = ["row", "query_id", "asked", "vec_id", "score", "copies"]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by cell, queries first, then shards, impacts descending."""
        cell, block, forward, segments, shard = None, None, None, [], None

        def close() -> None:
            if forward is not None and len(block.rows):
                block.search(Shard(forward, segments))

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in STREAM]
            for i in range(batch.num_rows):
                here, of, level, row, vec_id, asked, v, rows, ids, copies, body, width = (c[i].as_py() for c in columns)
                if here != cell:
                    if cell is not None:
                        close()
                        yield block.results()
                    cell, block, forward, segments, shard = here, Block(k), None, [], None
                    block.begin()
                if of is None:
                    block.queries.append((row, vec_id, asked, v))
                    continue
                if of != shard:
                    if shard is None:
                        block.begin()
                    close()
                    shard, forward, segments = of, (rows, ids, copies, body, width), []
                else:
                    segments.append((level, body))
        if cell is not None:
            close()
            yield block.results()

    return run


STREAM = ["cell", "shard", "level", "row", "vec_id", "asked", "v", "rows", "ids", "copies", "body", "width"]


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    scale: int = 64,
    shard_rows: int = 4_096,
    block_rows: int = 4_096,
    min_cells: int = 256,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row that is a query.

    Components x become floor(scale * x); the score is the integer inner product,
    and ties go to the smaller vec_id. ``is_query`` is a condition on ``vec_id``.
    Every row is a candidate but the query's own; with fewer than k others all are
    returned. Missing components of shorter vectors count as zero.

    Rows are dealt into shards of about ``shard_rows`` by hash, and each shard is
    stored as posting segments by descending impact (the size of the component).
    Queries come in blocks of about ``block_rows``. A task holds one block and lets
    the shards of its cell pass by one at a time, so its memory is bounded, and the
    k-th best scores found rise from shard to shard. Each of at least ``min_cells``
    cells, if there are as many shards, returns k rows a query at most.

    Rows without id, and vectors that are null or hold a null or non-finite
    component, take no part; empty vectors score zero. Rows repeated in full are
    scored once and counted as often as they occur: each is a query, and a
    candidate for the others. Scores are 64-bit. Other columns are ignored.
    """
    rows = quantised(vectors, vec_id=vec_id, vector=vector, scale=scale)
    asked = is_query.alias("asked")
    sizes = rows.select(asked).agg(F.count("*"), F.count_if("asked")).first()
    n_shards, n_blocks = (max(1, -(-n // size)) for n, size in zip(sizes, (shard_rows, block_rows)))
    n_groups = min(n_shards, -(-min_cells // n_blocks))
    index = build_index(rows, n_shards)

    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n_blocks))
    groups, blocks = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (n_groups, n_blocks))
    queries = rows.where(is_query).withColumn("grp", groups)
    queries = queries.select(
        (block * n_groups + F.col("grp")).alias("cell"), "row", "vec_id", F.col("copies").alias("asked"), "v"
    )
    passing = index.withColumn("block", blocks)
    passing = passing.withColumn("cell", F.col("block") * F.lit(n_groups).cast("long") + F.col("shard") % n_groups)
    both = queries.unionByName(passing.drop("block"), allowMissingColumns=True).select(*STREAM)
    dealt = both.repartition(min(4 * n_groups * n_blocks, 20_000), "cell")
    ordered = dealt.sortWithinPartitions("cell", F.col("shard").asc_nulls_first(), F.col("level").desc())
    found = ordered.mapInArrow(_search(k), ", ".join(f"{c} long" for c in FOUND))

    by_score = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    before = F.sum("copies").over(by_score.rowsBetween(Window.unboundedPreceding, -1))
    ranked = found.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < k)
    rank = F.explode(F.sequence(F.col("before") + 1, F.least(F.col("before") + F.col("copies"), F.lit(k))))
    ranked = ranked.select("query_id", "asked", rank.alias("rank"), "vec_id", "score")
    again = F.explode(F.sequence(F.lit(1).cast("long"), "asked"))
    ranked = ranked.withColumn("again", again)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


TOPK_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id,
         CAST(coalesce(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda i: a.q[i] * b.q[i])), 0)
              AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 20
"""
