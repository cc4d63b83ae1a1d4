"""Top-k search, periodic runs and structure repair against brute force, and on awkward rows."""

import hashlib
import heapq
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import TINY
from tidemark.llm import periodic_runs, queries, structure_repair, suffixes, topk_search

INF = float("inf")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Suffix arrays


def test_shared_prefixes_of_long_repeats():
    for words in ([1, 2] * 300, [1] * 500, [1, 2, 3, 1, 2] * 100 + [4] + [1, 2, 3, 1, 2] * 90):
        symbols = np.array([*words, 0])
        order, rank, lcp = suffixes.sort_suffixes(symbols)
        assert rank[order].tolist() == list(range(len(symbols)))
        for k in range(1, len(symbols)):
            a, b = words[order[k - 1] :], words[order[k] :]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert lcp[k] == n


def test_least_and_smaller_values():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 33, 64):
        values = rng.integers(0, 6, n).astype(np.int32)
        values[0] = -1
        levels = suffixes.pyramid(values)
        pairs = [(a, b) for a in range(n) for b in range(a + 1, n + 1)]
        low, high = np.array(pairs).T
        assert suffixes.least_between(levels, low, high).tolist() == [values[a:b].min() for a, b in pairs]
        at = np.arange(1, n)
        for strict in (True, False):
            found = suffixes.smaller_before(levels, at, strict)
            fits = [[i for i in range(k) if values[i] < values[k] or not strict and values[i] == values[k]] for k in at]
            assert found.tolist() == [x[-1] for x in fits]


# Top-k search


def top_by_force(rows, k):
    rows = [
        (i, [int(np.floor(64 * x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and abs(x) < INF for x in v)
    ]
    out = []
    for a, (i, v) in enumerate(rows):
        if i % 20 == 0:
            others = [(-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(rows) if a != b]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(sorted(others)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 30, "block_rows": 9, "min_cells": 3}])
@pytest.mark.parametrize("alike", [0, 3, 1])
def test_top_k_equals_brute_force(spark, sizes, alike):
    rng = random.Random(alike)
    rows = []
    for i in range(240):
        size = rng.choice([0, 3, 8, 8, 8, 8])
        # Of each ``alike`` vectors all but one are equal.
        v = [0.1] * 8 if alike and i % 4 % alike == 0 else [rng.gauss(0, 0.3) for _ in range(size)]
        v = {7: None, 8: [None, 1.0], 9: [float("nan"), 1.0], 10: [INF], 11: [1e9] * 8}.get(i, v)
        rows.append((i * 5 if i != 33 else None, v))
    # One row makes up a third of all.
    rows += rows[:30] + [rows[4]] * 120
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, row string, score int")
    found = topk_search.top_k(df, F.col("vec_id") % 20 == 0, k=5, **sizes)
    assert sorted(map(tuple, found.collect())) == top_by_force(rows, 5)


def test_segments_are_in_order_of_impact_and_reading_stops_early():
    rng = np.random.default_rng(5)
    vectors = np.floor(rng.normal(0, 8, (2000, 64))).astype(np.int64)
    forward, segments = index_of(vectors)
    assert [level for level, _ in segments] == sorted({abs(x) for x in vectors.ravel().tolist()} - {0}, reverse=True)
    assert sum(len(body) for _, body in segments) == 8 * np.count_nonzero(vectors)
    shard = topk_search.Shard(forward, segments)
    parts = shard.possible(vectors[:50], np.arange(50), np.full(50, -np.inf), 20)
    pairs, bands = [], 0
    for line, column in parts:
        pairs += zip(line.tolist(), column.tolist())
        bands += 1
    scores = vectors[:50] @ vectors.T
    for q in range(50):
        best = [c for c in np.lexsort((np.arange(2000), -scores[q])).tolist() if c != q][:20]
        assert set(best) <= {c for line, c in pairs if line == q}
    # Proof comes before the last band for most queries, and leaves few vectors to rescore.
    assert bands < len(shard.bands) or len(pairs) < 50 * 2000 / 8


def index_of(vectors):
    import pyarrow as pa

    n = len(vectors)
    numbers = pa.array(range(n), pa.int64())
    table = pa.table(
        {
            "shard": pa.array([0] * n, pa.int32()),
            "row": numbers,
            "vec_id": numbers,
            "copies": pa.array([1] * n, pa.int64()),
            "v": pa.array(vectors.tolist(), pa.list_(pa.int64())),
        }
    )
    first, *rest = topk_search._build(table).to_pylist()
    return tuple(first[c] for c in ("rows", "ids", "copies", "body", "width")), [(r["level"], r["body"]) for r in rest]


def test_top_k_of_empty_tables(spark):
    for rows in ([], [(20, [0.5])], [(20, None)], [(None, [1.0])], [(20, []), (40, [])]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        found = topk_search.top_k(df, F.col("vec_id") % 20 == 0)
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        both = [(20, 1, 40, 0), (40, 1, 20, 0)] if len(rows) == 2 else []
        assert sorted(map(tuple, found.collect())) == both


# Periodic runs


def runs_by_force(words, min_words):
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(min_words, 2 * p):
                found.setdefault((i, j + p - i), p)
            i = j + 1
    return sorted((start, period, length) for (start, length), period in found.items())


@pytest.mark.parametrize("min_words", [1, 4, 12])
def test_runs_equal_brute_force(min_words):
    rng = random.Random(min_words)
    for _ in range(60):
        docs = []
        for _ in range(rng.randint(1, 6)):
            n, k = rng.randint(0, 90), rng.randint(1, 4)
            words = [rng.randint(1, k) for _ in range(n)]
            if n and rng.random() < 0.5:
                a, p = rng.randrange(n), rng.randint(1, 1 + n // 3)
                words = [w if i < a else words[min(n - 1, a + (i - a) % p)] for i, w in enumerate(words)]
            docs.append(np.array(words, np.int64))
        found = [[] for _ in docs]
        for doc, start, length, period in zip(*(x.tolist() for x in periodic_runs.find_runs(docs, min_words))):
            found[doc].append((start, period, length))
        assert found == [runs_by_force(d.tolist(), min_words) for d in docs]


def test_long_rotations():
    unit = np.random.default_rng(0).integers(1, 500, 700)
    for words in (np.ones(50_000, np.int64), np.tile(unit, 40), np.tile(unit, 40)[13:-29]):
        period = 1 if words[0] == words[1] == words[2] else 700
        doc, start, length, periods = periodic_runs.find_runs([words, words[:5]], 12)
        top = length.argmax()
        assert (doc[top], start[top], length[top], periods[top]) == (0, 0, len(words), period)


def test_small_pieces_of_checks_change_nothing(monkeypatch):
    docs = [np.random.default_rng(i).integers(1, 3, 200) for i in range(4)]
    whole = periodic_runs.find_runs(docs, 4)
    monkeypatch.setattr(periodic_runs, "CHECKED", 7)
    assert all((a == b).all() for a, b in zip(whole, periodic_runs.find_runs(docs, 4)))


ROWS = [
    (1, "a b " * 10, "n"),
    (1, "a b " * 10, "n"),
    (2, None, "n"),
    (None, "x " * 20, None),
    (3, "", ""),
    (4, " \t\n", ""),
    (5, "word " * 30_000, ""),
    (6, "é ü é ü é ü é ü", ""),
    (7, "a a b a a b a a b a a b a a b", ""),
]


def test_runs_of_awkward_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, n_runs string")
    found = [r.asDict(recursive=True) for r in periodic_runs.periodic_runs(docs, batch_words=50).collect()]
    by_id = {r["doc_id"]: r for r in found}
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in ROWS)
    assert by_id[1]["runs"] == [{"start": 0, "length": 20, "period": 2}] and bytes(by_id[1]["collapsed"]) == b"a b"
    assert by_id[5]["runs"] == [{"start": 0, "length": 30_000, "period": 1}] and bytes(by_id[5]["collapsed"]) == b"word"
    assert by_id[7]["runs"] == [{"start": 0, "length": 15, "period": 3}] and bytes(by_id[7]["collapsed"]) == b"a a b"
    assert bytes(by_id[6]["collapsed"]).decode() == "é ü é ü é ü é ü"
    for i in (2, 3, 4):
        assert by_id[i]["n_words"] == 0 and by_id[i]["runs"] == [] and bytes(by_id[i]["collapsed"]) == b""
    digests = {r.doc_id: r for r in periodic_runs.run_digests(periodic_runs.periodic_runs(docs)).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert tuple(digests[2]) == (2, 0, None, None, None, None, nothing, nothing)
    assert digests[7][1:6] == (1, 0, 15, 3, 5000)
    assert digests[7].runs_sha256 == hashlib.sha256(b"0,15,3\n").hexdigest()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.run_digests(periodic_runs.periodic_runs(periodic_runs.cycled_tails(empty))).count() == 0


def test_cycled_tails(spark):
    import zlib

    rows = [(i, " ".join(f"w{j}" for j in range(i % 37)), "x") for i in range(400)] + [(None, "a b", "x"), (10, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, w string")
    found = periodic_runs.cycled_tails(docs).collect()
    changed = 0
    expected = []
    for i, text, _ in rows:
        words = (text or "").split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(w if j < a else words[a + (j - a) % p] for j, w in enumerate(words))
            changed += 1
        expected.append((i, text))
    assert sorted(map(str, expected)) == sorted(str((r.doc_id, r.text)) for r in found) and changed > 10


# Structure repair


def repaired_by_force(rows):
    """Cheapest (cost, audit, repaired) over all edits, by a search over (next turn, state)."""
    seen, kinds = set(), []
    faults = [0, 0, 0]
    for _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        kind = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else 3
        seen.add((role, text))
        kinds.append(kind)
        if kind < 3:
            faults[kind] += 1
    follows = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return faults, cost, audit, "\n".join(out)
        if (i, state) in done:
            continue
        done.add((i, state))
        for initial, then in follows[state].items():
            if initial != "s":
                heapq.heappush(heap, (cost + 2, audit + "I", i, then, (*out, f"{names[initial]}:")))
            if i < len(rows) and kinds[i] > 1:
                _, role, text = rows[i]
                late = int(kinds[i] == 2)
                if role[:1] == initial:
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, then, (*out, f"{role}:{text}")))
                if initial != "s":
                    name = names[initial]
                    heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, then, (*out, f"{name}:{text}")))
        if i < len(rows):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))


def conversation(rng, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "unit"]
    texts = ["Hello there.", "Why?", "cut off", "", " \n", "More text!  ", "no end,"]
    return [(t, rng.choice(roles), rng.choice(texts) + (f" {t}." if rng.random() < 0.6 else "")) for t in range(n)]


def report_of(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    report, turns = structure_repair.repair_conversations(df)
    digests = {r.conv_id: r.repaired_sha256 for r in structure_repair.turn_digests(turns).collect()}
    return {r.conv_id: r for r in report.collect()}, digests


@pytest.mark.parametrize("shift", [9, 0, 1])
def test_repair_equals_brute_force(spark, monkeypatch, shift):
    monkeypatch.setattr(structure_repair, "SHIFT", shift)
    rng = random.Random(shift)
    conversations = {i: conversation(rng, rng.randint(1, 9)) for i in range(150)}
    conversations[500] = conversation(rng, 400)
    found, digests = report_of(spark, [(i, *turn) for i, turns in conversations.items() for turn in turns])
    nothing = hashlib.sha256(b"").hexdigest()
    for i, turns in conversations.items():
        faults, cost, audit, text = repaired_by_force(turns)
        row = found[i]
        assert [row.blank, row.duplicate, row.truncated] == faults
        assert (row.cost, row.audit) == (cost, audit)
        assert digests.get(i, nothing) == hashlib.sha256(text.encode()).hexdigest()
        initials = [role[:1] for _, role, _ in turns]
        assert row.illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def test_weights_compare_like_cost_and_letters():
    rng = random.Random(8)
    w = structure_repair.Weights(12)
    paths = []
    for _ in range(200):
        letters = [(rng.randint(1, 4), rng.randint(0, 3)) for _ in range(rng.randint(0, 12))]
        path = w.end(0)
        for letter, cost in reversed(letters):
            path = w.before(letter, cost, path)
        audit = "".join(structure_repair.LETTERS[letter] for letter, _ in letters)
        assert w.letters(path) == audit and w.cost(path) == sum(cost for _, cost in letters)
        paths.append((path, (w.cost(path), audit)))
    assert [x for _, x in sorted(paths)] == sorted(x for _, x in paths)


def test_repair_of_awkward_rows(spark):
    rows = [
        (1, None, "user", "Hi."),
        (1, 5, "assistant", "Ho."),
        (1, 9, None, None),
        (None, 1, "user", "Hi."),
        (None, 1, "assistant", "Ho."),
        (2, None, "assistant", "Only."),
        (2, None, "assistant", "Only."),
        (3, 1, "system", "x. " * 20_000),
    ]
    found, digests = report_of(spark, rows)
    assert found[1].gaps == 3 and found[1].blank == 1 and found[1].audit == "KKD" and found[1].cost == 3
    # Equal numbers are ordered by role.
    assert found[None].audit == "DIK" or found[None].cost == 4
    assert found[2].gaps == 0 and found[2].duplicate == 1
    assert found[3].audit == "D" and 3 not in digests
    report, turns = structure_repair.repair_conversations(
        spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    )
    assert report.count() == 0 and turns.count() == 0


def test_repair_query_returns_every_conversation(spark):
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", f"Text {t}.", "x") for i in range(300) for t in range(i % 3)]
    rows += [(None, None, None, None, None), (7, 3, None, "a", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string")
    found = structure_repair.repair_query(df).collect()
    assert sorted(str(r.conv_id) for r in found) == sorted({str(r[0]) for r in rows})
    empty = [r for r in found if r.audit == "" and r.cost == 0]
    assert empty and all(r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in empty)
    assert structure_repair.repair_query(df.limit(0)).count() == 0


def test_one_long_conversation_is_settled_in_many_tasks(spark):
    rows = spark.range(20_000).selectExpr(
        "if(id < 15000, 0L, id) as conv_id", "id as turn",
        "if(id % 2 = 0, 'user', 'assistant') as role", "concat('Turn ', id, '.') as text",
    )
    ordered = structure_repair.ordered_turns(rows)
    parts = structure_repair._segments(ordered).where("conv_id = 0")
    sizes = [len(r.turns) for r in parts.collect()]
    assert sum(sizes) == 15_000 and max(sizes) <= 512
    found = structure_repair.conversation_report(ordered, structure_repair.edits(ordered))
    assert found.where("conv_id = 0").first().audit == "K" * 15_000


@pytest.mark.parametrize("name", ["op11_topk_search", "op12_periodic_runs", "op13_structure_repair"])
def test_queries_cover_their_tables(spark, name):
    found = queries.QUERIES[name](spark, TINY)
    if name == "op12_periodic_runs":
        assert found.count() == spark.read.parquet(f"{TINY}/documents.parquet").count()
    elif name == "op13_structure_repair":
        assert found.count() == spark.read.parquet(f"{TINY}/conversations.parquet").select("conv_id").distinct().count()
    else:
        asked = spark.read.parquet(f"{TINY}/embeddings.parquet").where("vec_id % 20 = 0").count()
        assert found.count() == 20 * asked
