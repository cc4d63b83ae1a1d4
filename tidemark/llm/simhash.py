"""Near-duplicate documents by SimHash fingerprints and a binary trie self-join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged, unused
from tidemark.llm.components import component_roots

BITS, QUARTER = 64, 16
#: Node pairs that are expanded at once, and leaf pairs below which two nodes
#: are compared directly: together they bound a task's memory.
BLOCK, LEAF_PAIRS = 1 << 16, 32


def simhash(text: str | None, width: int = 3, block: int = 1 << 16) -> int:
    """Unsigned 64-bit fingerprint of the word shingles of a text.

    Words are cut at ASCII white space after lower-casing A-Z. A bit is set if
    it is set in over half of the shingle hashes. No words: 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) <= width:
        hashes = iter([digest(b" ".join(words), 42)])
        n = 1
    else:
        hashes = (digest(s, 42) for s in map(b" ".join, zip(*(words[i:] for i in range(width)))))
        n = len(words) - width + 1
    ones = np.zeros(BITS, np.int64)
    for start in range(0, n, block):
        raw = b"".join(next(hashes) for _ in range(min(block, n - start))) if n > block else b"".join(hashes)
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, text_hash) for every row; fp as signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((simhash(t.as_py()) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.record_batch(
                [batch.column(0), pa.array(fps.view(np.int64)), batch.column(1)], ["doc_id", "fp", "text_hash"]
            )

    source = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, fp bigint, text_hash bigint")


def _zeros_end(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Where the one-child of each node [lo, hi) begins, by binary search."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        one = (keys[np.minimum(mid, len(keys) - 1)] >> shift) & np.uint64(1) == 1
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)
    return lo


def _leaf_pairs(keys, lo, hi, lo2, hi2, budget):
    """Entry pairs of small nodes whose whole keys differ in at most ``budget`` bits."""
    wide = hi2 - lo2
    count = (hi - lo) * wide
    which = np.repeat(np.arange(len(lo)), count)
    at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    i, j = lo[which] + at // wide[which], lo2[which] + at % wide[which]
    near = (i < j) & (np.bitwise_count(keys[i] ^ keys[j]) <= budget)
    return i[near], j[near]


def trie_pairs(keys: np.ndarray, roots: tuple[np.ndarray, ...], budget: int = 3):
    """Yields index pairs (i < j) of keys within ``budget`` differing bits.

    ``keys`` are sorted within each trie; a node is a range of them that agrees
    in its first ``depth`` bits. ``roots`` = (lo, hi, lo2, hi2, depth, diff):
    pairs of nodes, equal ranges for a trie with itself, and the bits in which
    their prefixes differ. Two nodes are walked down together; children that
    differ in the next bit add one to ``diff``, and a pair over budget is cut
    off with all below it. Blocks of pairs wait on a stack, so memory is bounded
    by the depth, not by the number of pairs.
    """
    stack = [tuple(np.asarray(r) for r in roots)]
    while stack:
        block = stack.pop()
        if len(block[0]) > BLOCK:
            stack.append(tuple(x[BLOCK:] for x in block))
            block = tuple(x[:BLOCK] for x in block)
        lo, hi, lo2, hi2, depth, diff = block
        own = lo == lo2
        alive = (hi > lo) & (hi2 > lo2) & (diff <= budget) & ~(own & (hi - lo == 1))
        leaf = alive & (((hi - lo) * (hi2 - lo2) <= LEAF_PAIRS) | (depth == BITS))
        if leaf.any():
            yield _leaf_pairs(keys, lo[leaf], hi[leaf], lo2[leaf], hi2[leaf], budget)
        go = alive & ~leaf
        if not go.any():
            continue
        lo, hi, lo2, hi2, depth, diff, own = (x[go] for x in (lo, hi, lo2, hi2, depth, diff, own))
        shift = (BITS - 1 - depth).astype(np.uint64)
        mid, mid2 = _zeros_end(keys, lo, hi, shift), _zeros_end(keys, lo2, hi2, shift)
        down, more, other = depth + 1, diff + 1, ~own
        children = [
            (lo, mid, lo2, mid2, down, diff),
            (mid, hi, mid2, hi2, down, diff),
            (lo, mid, mid2, hi2, down, more),
            tuple(x[other] for x in (mid, hi, lo2, mid2, down, more)),
        ]
        stack.append(tuple(np.concatenate(x) for x in zip(*children)))


def spanning_edges(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unites the entries i and j in ``parent``, where every tree's root is its smallest entry."""
    while len(i):
        for end in (i, j):
            while (parent[end] != parent[parent[end]]).any():
                parent[end] = parent[parent[end]]
        i, j = parent[i], parent[j]
        apart = i != j
        i, j = np.minimum(i[apart], j[apart]), np.maximum(i[apart], j[apart])
        np.minimum.at(parent, j, i)


def _join_partition(budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        turn, block, p, q, k, key = (
            table.column(c).to_numpy() for c in ("turn", "block", "p", "q", "k", "key")
        )
        order = np.lexsort((key.view(np.uint64), q, p, block, turn))
        turn, block, p, q, k, key = (x[order] for x in (turn, block, p, q, k, key))
        keys = key.view(np.uint64)
        new = np.ones(len(keys), bool)
        new[1:] = (np.diff(turn) != 0) | (np.diff(block) != 0) | (np.diff(p) != 0) | (np.diff(q) != 0)
        lo = np.flatnonzero(new)
        hi = np.append(lo[1:], len(keys))
        depth = QUARTER + k[lo].astype(np.int64)
        # A task of two subtries: the first has the smaller prefix, so it comes first.
        prefix = (keys >> (BITS - depth[np.cumsum(new) - 1]).astype(np.uint64)) & (
            (np.uint64(1) << k.astype(np.uint64)) - np.uint64(1)
        )
        cut = lo + np.add.reduceat((prefix == p.astype(np.uint64)).astype(np.int64), lo)
        two = p[lo] != q[lo]
        roots = (
            lo,
            np.where(two, cut, hi),
            np.where(two, cut, lo),
            hi,
            depth,
            np.bitwise_count(p[lo] ^ q[lo]).astype(np.int64),
        )
        parent = np.arange(len(keys))
        for i, j in trie_pairs(keys, roots, budget):
            spanning_edges(parent, i, j)
        spanning_edges(parent, np.arange(len(keys)), parent.copy())
        linked = np.flatnonzero(parent != np.arange(len(keys)))
        if not len(linked):
            return
        back = (turn[linked] * QUARTER).astype(np.uint64)

        def unturned(x: np.ndarray) -> np.ndarray:
            return ((x >> back) | (x << ((np.uint64(BITS) - back) % np.uint64(BITS)))).view(np.int64)

        a, b = unturned(keys[linked]), unturned(keys[parent[linked]])
        for s in range(0, len(a), 1 << 16):
            yield pa.record_batch([pa.array(a[s : s + (1 << 16)]), pa.array(b[s : s + (1 << 16)])], ["a", "b"])

    return run


def fingerprint_links(fps: DataFrame, budget: int = 3, split_at: int = 100_000) -> DataFrame:
    """Edges (a, b) that span all links of at most ``budget`` <= 3 bits among distinct ``fp``.

    Two fingerprints with three differing bits agree in one of their four
    quarters. Each quarter is rotated to the front in turn, and those that agree
    in it are one trie below depth 16, joined with itself in one task. A trie of
    more than ``split_at`` keys, such as that of a huge group of near copies, is
    cut k levels further down: a task then is a pair of subtries whose prefixes
    differ in at most ``budget`` bits. Within a task links are united at once,
    so it returns fewer edges than it has keys, however dense the group.
    """
    turned = fps.select(
        F.explode(F.array(*[F.lit(t) for t in range(BITS // QUARTER)])).alias("turn"), "fp"
    ).select(
        "turn",
        F.expr(
            f"shiftleft(fp, turn * {QUARTER}) | if(turn = 0, 0L, "
            f"shiftrightunsigned(fp, {BITS} - turn * {QUARTER}))"
        ).alias("key"),
    )
    turned = turned.withColumn("block", F.shiftrightunsigned("key", BITS - QUARTER))
    hot = (
        turned.groupBy("turn", "block")
        .count()
        .where(F.col("count") > split_at)
        .withColumn("k", F.least(F.lit(12), F.ceil(F.log2(F.col("count") / split_at)) + 1).cast("int"))
        .select(
            "turn",
            "block",
            "k",
            F.expr(f"filter(sequence(0L, shiftleft(1L, k) - 1), m -> bit_count(m) <= {budget})").alias("masks"),
        )
    )
    tasks = (
        turned.join(hot, ["turn", "block"], "left")
        .withColumn("k", F.coalesce("k", F.lit(0)))
        .withColumn("at", F.expr(f"shiftrightunsigned(shiftleft(key, {QUARTER}), 1) "))
        .withColumn("at", F.expr("if(k = 0, 0L, shiftrightunsigned(at, 63 - k))"))
        .withColumn("mask", F.explode(F.coalesce("masks", F.array(F.lit(0).cast("long")))))
        .withColumn("other", F.expr("at ^ mask"))
        .select("turn", "block", F.least("at", "other").alias("p"), F.greatest("at", "other").alias("q"), "k", "key")
    )
    return tasks.repartition("turn", "block", "p", "q").mapInArrow(_join_partition(budget), "a bigint, b bigint")


def near_duplicate_components(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    budget: int = 3,
    split_at: int = 100_000,
) -> DataFrame:
    """(doc_id, fp, text_hash, component_id, root), one row per row of ``docs``.

    Texts whose fingerprints differ in at most ``budget`` bits are linked;
    ``component_id`` is the smallest doc_id that can be reached, and ``root`` the
    smallest fingerprint, which every component has and no two share. Equal
    fingerprints are one node, so copies make no pairs.

    Null and empty texts have fingerprint zero and are linked like others.
    Rows without doc_id take part; their component id is null only if no row of
    the component has one. Repeated rows are repeated. Other columns are ignored.
    """
    fps = staged(fingerprints(docs, doc_id, text), "fingerprints")
    classes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    links = fingerprint_links(classes.select("fp"), budget, split_at)
    roots = component_roots(links)
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = staged(rooted, "rooted-fingerprints")
    # Written first: the join with it can be split where a component is very large.
    ids = staged(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    named = rooted.join(ids, "root").select("fp", "component_id", "root")
    return fps.join(named, "fp").select("doc_id", "fp", "text_hash", "component_id", "root")


def one_per_component(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of each near-duplicate component with the smallest doc_id.

    Among rows with that id the smallest text hash decides, and of rows with the
    same id and text one stays. A row without doc_id is chosen only where a
    component has no other.
    """
    found = near_duplicate_components(docs, doc_id=doc_id, text=text)
    ranked = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    # Not by component_id: it is null without any doc_id, and a repeated doc_id may stand for two components.
    chosen = found.groupBy("root").agg(F.min(ranked).alias("c"))
    key, hashed = unused(docs, "chosen_doc", "chosen_hash")
    chosen = chosen.select(F.col("c.doc_id").alias(key), F.col("c.text_hash").alias(hashed)).distinct()
    (own,) = unused(docs, "own_hash")
    docs = docs.withColumn(own, F.xxhash64(text))
    kept = docs.join(chosen, docs[doc_id].eqNullSafe(chosen[key]) & (docs[own] == chosen[hashed]), "left_semi")
    return kept.dropDuplicates([doc_id, own]).drop(own)
