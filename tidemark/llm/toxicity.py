"""Toxicity scores from a small convolutional text classifier in numpy."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_BYTES, remainder, staged

THRESHOLD = 0.3
#: Two hash tables of embeddings: of words, and of what words begin with, which
#: inflected forms have in common.
TABLE, WIDTH, STEM_BYTES = 1 << 18, 8, 6
FILTERS, SIZES = 8, (1, 2, 3)

#: Function words by which a text is put into a language group for calibration.
FUNCTION_WORDS = {
    "en": "the and of to in is that for it with as was on by this be are from",
    "fr": "le la les et des est un une du que qui dans pour par sur pas au avec",
    "de": "der die das und ist von zu den mit nicht ein eine im dem auf für sich als",
    "es": "el los las del que y en un una por con para se su es al como lo",
}
GROUPS = [*FUNCTION_WORDS, "other"]


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


class Vocabulary:
    """Embedding rows and language group of words, by a bounded cache."""

    def __init__(self, size: int = 300_000):
        self.size = size
        self.rows: dict[bytes, int] = {}
        self.group: dict[bytes, int] = {}
        for g, words in enumerate(FUNCTION_WORDS.values()):
            for word in words.split():
                # A word of several languages speaks for none.
                key = word.encode()
                self.group[key] = -1 if key in self.group else g

    def _row(self, word: bytes) -> int:
        # Both rows in one number; 0 is kept free for the gap between texts.
        row = (1 + zlib.crc32(word) % (TABLE - 1)) * TABLE + 1 + zlib.crc32(word[:STEM_BYTES], 7) % (TABLE - 1)
        if len(self.rows) >= self.size:
            self.rows.clear()
        self.rows[word] = row
        return row

    def encode(self, text: str | None) -> tuple[np.ndarray, int]:
        """(rows of the words, language group) of a text."""
        words = words_of(text)
        known = list(map(self.rows.get, words))
        if None in known:
            known = [self._row(w) if k is None else k for w, k in zip(words, known)]
        votes = [0] * len(FUNCTION_WORDS)
        for word in self.group.keys() & set(words):
            if (g := self.group[word]) >= 0:
                votes[g] += 1
        best = max(votes)
        return np.array(known, np.int64), votes.index(best) if best else len(FUNCTION_WORDS)


@dataclass
class ToxicityModel:
    """Embeddings, filters, output weights, and one threshold per language group."""

    first: np.ndarray
    second: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    offset: float
    thresholds: dict[int, float] = field(default_factory=dict)
    default: float = 0.5

    def embed(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.first[rows // TABLE], self.second[rows % TABLE]], axis=1)

    def activations(self, rows: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
        """One (places, filters) array per filter size, a window from each place on.

        A window that would reach from the gap into the next text counts as one within the gap.
        """
        embedded = self.embed(rows)
        out = []
        for size, filters in zip(SIZES, self.filters):
            n = len(rows) - size + 1
            found = sum(embedded[t : t + n] @ filters[t] for t in range(size))
            for before in range(1, size):
                found[stops - before] = found[stops - size]
            out.append(found)
        return out

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        hidden = np.maximum(pooled + self.bias, 0)
        return 1 / (1 + np.exp(-np.clip(hidden @ self.out + self.offset, -30, 30)))

    def raw_scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Probabilities before calibration; texts without words have an empty gap only."""
        rows, starts, stops = joined(texts)
        pooled = [np.maximum.reduceat(a, starts)[: len(starts)] for a in self.activations(rows, stops)]
        return self.probability(np.concatenate(pooled, axis=1))

    def calibrated(self, raw: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """Scores on which each group's threshold falls on THRESHOLD."""
        cut = np.array([self.thresholds.get(g, self.default) for g in range(len(GROUPS))])[groups]
        low = THRESHOLD * raw / cut
        high = THRESHOLD + (1 - THRESHOLD) * (raw - cut) / (1 - cut)
        return np.clip(np.where(raw < cut, low, high), 0, 1)


GAP = max(SIZES)


def joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in one array, a gap of empty words after each; starts and ends of each with its gap."""
    sizes = np.array([len(t) + GAP for t in texts])
    stops = np.cumsum(sizes)
    rows = np.zeros(int(stops[-1]) + GAP if len(texts) else GAP, np.int64)
    starts = stops - sizes
    for s, t in zip(starts, texts):
        rows[s : s + len(t)] = t
    return rows, starts, stops


#: Words that are embedded at a time, and words of one piece of a long text.
BLOCK_WORDS, PIECE = 200_000, 1 << 16


def winners(model: ToxicityModel, texts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Largest activation of each filter in each text, and the words of the window where it stands.

    Windows are (texts, size, filters) arrays, one per filter size. Long texts are
    looked at in pieces, whose windows reach into the next piece.
    """
    pieces = [(i, t, s) for i, t in enumerate(texts) for s in range(0, max(len(t), 1), PIECE)]
    best = [np.full((len(texts), FILTERS), -np.inf) for _ in SIZES]
    windows = [np.zeros((len(texts), size, FILTERS), np.int64) for size in SIZES]
    begin = 0
    while begin < len(pieces):
        end, size = begin, 0
        while end < len(pieces) and (end == begin or size < BLOCK_WORDS):
            size += min(PIECE, len(pieces[end][1]) - pieces[end][2])
            end += 1
        block, begin = pieces[begin:end], end
        rows, starts, stops = joined([t[s : s + PIECE + GAP - 1] for _, t, s in block])
        # Only the last piece has windows in the gap.
        ends = [e if s + PIECE >= len(t) else b + PIECE for (_, t, s), b, e in zip(block, starts, stops)]
        owners = np.array([i for i, _, _ in block])
        for k, (size, a) in enumerate(zip(SIZES, model.activations(rows, stops))):
            won = np.array([s + a[s:e].argmax(axis=0) for s, e in zip(starts, ends)])
            found = np.take_along_axis(a, won, axis=0)
            words = rows[won[:, None] + np.arange(size)[:, None]]
            if len(pieces) == len(texts):
                best[k][owners], windows[k][owners] = found, words
                continue
            for j, i in enumerate(owners):
                better = found[j] > best[k][i]
                best[k][i] = np.where(better, found[j], best[k][i])
                windows[k][i] = np.where(better, words[j], windows[k][i])
    return np.concatenate(best, axis=1).astype(np.float32), windows


def initial(seed: int) -> dict[str, np.ndarray]:
    """Weights before anything is learned; what is never learned keeps embeddings near zero."""
    rng = np.random.default_rng(seed)
    kinds = len(SIZES) * FILTERS
    p = {
        "first": rng.normal(0, 0.01, (TABLE, WIDTH)).astype(np.float32),
        "second": rng.normal(0, 0.01, (TABLE, WIDTH)).astype(np.float32),
        "bias": np.zeros(kinds, np.float32),
        "out": rng.normal(0, 0.5, kinds).astype(np.float32),
        "offset": np.zeros(1, np.float32),
    }
    for size in SIZES:
        p[f"f{size}"] = rng.normal(0, 0.4, (size, 2 * WIDTH, FILTERS)).astype(np.float32)
    p["first"][0] = p["second"][0] = 0
    return p


def model_of(p: dict[str, np.ndarray]) -> ToxicityModel:
    filters = [p[f"f{s}"] for s in SIZES]
    return ToxicityModel(p["first"], p["second"], filters, p["bias"], p["out"], float(p["offset"][0]))


class Learner:
    """Weights on their way from common ones, by Adam; gradients flow through the places that won the pooling."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.before = weights
        self.p = {k: v.copy() for k, v in weights.items()}
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.step = 0

    def learn(self, texts: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator) -> None:
        for batch in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // 32)):
            if len(batch):
                self._descend([texts[i] for i in batch], labels[batch])

    def _descend(self, texts: list[np.ndarray], labels: np.ndarray) -> None:
        self.step += 1
        p, model = self.p, model_of(self.p)
        pooled, windows = winners(model, texts)
        miss = (model.probability(pooled) - labels) / len(labels)
        active = pooled + p["bias"] > 0
        back = miss[:, None] * p["out"] * active
        grads = {
            "out": np.maximum(pooled + p["bias"], 0).T @ miss + 1e-4 * p["out"],
            "offset": np.array([miss.sum()], np.float32),
            "bias": back.sum(axis=0),
        }
        touched, pulls = [], []
        for k, (size, found) in enumerate(zip(SIZES, windows)):
            own = back[:, k * FILTERS : (k + 1) * FILTERS]
            grad = np.zeros_like(p[f"f{size}"])
            for t in range(size):
                words = found[:, t]
                vectors = model.embed(words.ravel()).reshape(*words.shape, -1)
                grad[t] = np.einsum("bf,bfd->df", own, vectors)
                touched.append(words.ravel())
                pulls.append((own[:, :, None] * p[f"f{size}"][t].T[None]).reshape(-1, 2 * WIDTH))
            grads[f"f{size}"] = grad
        words, pull = np.concatenate(touched), np.concatenate(pulls)
        for name, part, at in (("first", pull[:, :WIDTH], words // TABLE), ("second", pull[:, WIDTH:], words % TABLE)):
            rows_, where = np.unique(at, return_inverse=True)
            total = np.zeros((len(rows_), WIDTH), np.float32)
            np.add.at(total, where, part)
            total[rows_ == 0] = 0
            _adam(p[name], self.moments[name], total, self.step, rows_)
        for name, grad in grads.items():
            _adam(p[name], self.moments[name], grad, self.step)

    def moved(self) -> pa.RecordBatch:
        """What the weights have moved by, in rows of ``WIDTH``: embeddings that did move, and all others.

        In fixed point, so that sums do not depend on their order.
        """
        tables, rows, ways = [], [], []
        for n, name in enumerate(("first", "second")):
            way = self.p[name] - self.before[name]
            found = np.flatnonzero(way.any(axis=1))
            tables.append(np.full(len(found), n))
            rows.append(found)
            ways.append(way[found])
        way = _flat(self.p) - _flat(self.before)
        tables.append(np.full(len(way), 2))
        rows.append(np.arange(len(way)))
        ways.append(way)
        ways = np.rint(np.concatenate(ways).astype(np.float64) * FIXED).astype(np.int64)
        columns = [np.concatenate(tables), np.concatenate(rows), *ways.T]
        return pa.record_batch([pa.array(np.ascontiguousarray(c, np.int64)) for c in columns], _MOVED)


FIXED = float(1 << 32)
_MOVED = ["part", "row", *(f"w{i}" for i in range(WIDTH))]
_DENSE = ["bias", "out", "offset", *(f"f{s}" for s in SIZES)]


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    """All weights but the embeddings in rows of ``WIDTH``."""
    flat = np.concatenate([p[name].ravel() for name in _DENSE])
    return np.pad(flat, (0, -len(flat) % WIDTH)).reshape(-1, WIDTH)


def _moved_on(p: dict[str, np.ndarray], found: pa.Table) -> dict[str, np.ndarray]:
    """Weights moved by the mean way of the learners that moved them."""
    p = {k: v.copy() for k, v in p.items()}
    part, row, n = (found[c].to_numpy() for c in ("part", "row", "n"))
    ways = np.stack([found[f"w{i}"].to_numpy() for i in range(WIDTH)], axis=1) / (FIXED * n[:, None])
    for k, name in enumerate(("first", "second")):
        p[name][row[part == k]] += ways[part == k].astype(np.float32)
    flat = _flat(p)
    flat[row[part == 2]] += ways[part == 2].astype(np.float32)
    flat, at = flat.ravel(), 0
    for name in _DENSE:
        p[name] = flat[at : at + p[name].size].reshape(p[name].shape).copy()
        at += p[name].size
    return p


def _adam(value, moments, grad, step, rows=slice(None), rate=0.01):
    m, v = moments
    m[rows] = 0.9 * m[rows] + 0.1 * grad
    v[rows] = 0.99 * v[rows] + 0.01 * grad * grad
    value[rows] -= rate * (m[rows] / (1 - 0.9**step)) / (np.sqrt(v[rows] / (1 - 0.99**step)) + 1e-8)


#: Steps of the scores between 0 and 1 by which thresholds are set.
CUTS = 1 << 16


def _best_cut(positives: np.ndarray, negatives: np.ndarray) -> float:
    """The threshold of the best F1, halfway to the next lower score; counts are by step of the score."""
    seen = np.flatnonzero(positives + negatives)[::-1]
    hits, drawn = np.cumsum(positives[seen]), np.cumsum((positives + negatives)[seen])
    f1 = 2 * hits / (drawn + positives.sum())
    k = int(f1.argmax())
    below = seen[k + 1] + 0.5 if k + 1 < len(seen) else 0.0
    return float(np.clip((seen[k] + 0.5 + below) / 2 / CUTS, 0.02, 0.98))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray, np.ndarray]]:
    """(shard, texts, labels, groups) of up to 1,024 texts or a million words; the same ones however rows arrive."""
    shard, held, size = None, [], 0

    def block():
        return shard, [h[0] for h in held], np.array([h[1] for h in held], np.float32), np.array([h[2] for h in held])

    for batch in batches:
        columns = (batch.column(c) for c in ("shard", "words", "label", "language"))
        for own, words, label, language in zip(*columns):
            if held and (own.as_py() != shard or len(held) == 1_024 or size >= 1_000_000):
                yield block()
                held, size = [], 0
            shard = own.as_py()
            # A copy, as the batch is gone by the time the block is full.
            held.append((np.frombuffer(words.as_buffer(), np.int64).copy(), label.as_py(), language.as_py()))
            size += len(held[-1][0])
    if held:
        yield block()


def _labelled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, shard_texts: int) -> DataFrame:
    """Every labelled text as rows of its words, in shards by hash of its id: shard, kept_back, label, language, words."""
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1))
    known = known.groupBy(F.col(doc_id).alias("doc_id")).agg(F.min(F.col(label).cast("int")).alias("label"))
    shards = max(1, -(-known.count() // shard_texts))
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    found = source.join(known, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    found = found.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"),
        F.xxhash64("doc_id", F.lit("order")).alias("place"),
        (F.pmod(F.xxhash64("doc_id", F.lit("kept back")), F.lit(5)) == 0).alias("kept_back"),
        "label",
        "text",
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary()
        for batch in batches:
            encoded = [vocabulary.encode(value.as_py()) for value in batch.column("text")]
            languages = pa.array([e[1] for e in encoded], pa.int32())
            words = pa.array([e[0].tobytes() for e in encoded], pa.binary())
            columns = [*(batch.column(c) for c in ("shard", "place", "kept_back", "label")), languages, words]
            yield pa.record_batch(columns, ["shard", "place", "kept_back", "label", "language", "words"])

    encoded = found.mapInArrow(encode, "shard int, place long, kept_back boolean, label int, language int, words binary")
    return encoded.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "place", "words")


def _common(encoded: DataFrame, min_texts: int) -> np.ndarray:
    """Words and stems that stand in ``min_texts`` labelled texts or more, as two masks of their tables."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * TABLE, np.int64)
        for batch in batches:
            for words in batch.column(0):
                rows = np.unique(np.frombuffer(words.as_buffer(), np.int64))
                counts[np.unique(rows // TABLE)] += 1
                counts[np.unique(rows % TABLE) + TABLE] += 1
        found = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(found), pa.array(counts[found])], ["row", "n"])

    counts = encoded.select("words").mapInArrow(spread, "row long, n long").groupBy("row").agg(F.sum("n").alias("n"))
    mask = np.zeros(2 * TABLE, bool)
    mask[counts.where(F.col("n") >= min_texts).select("row").toArrow()["row"].to_numpy()] = True
    return mask.reshape(2, TABLE)


def _only_common(texts: list[np.ndarray], common: np.ndarray) -> list[np.ndarray]:
    """Texts in which rare words and rare stems are blank."""
    return [t // TABLE * common[0, t // TABLE] * TABLE + t % TABLE * common[1, t % TABLE] for t in texts]


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    min_texts: int = 2,
    epochs: int = 6,
    shard_texts: int = 4_096,
    seed: int = 7,
) -> ToxicityModel:
    """Model from all labelled rows, each text as a whole.

    Rows whose id, label or text is null are not used; of an id with several texts or
    labels the smallest count. Both labels are needed to learn.

    Texts are cut into shards of about ``shard_texts`` by a hash of the id. In each of
    ``epochs`` rounds, every shard starts from the common weights and learns from each of its
    texts once, shard by shard in tasks; the next weights are the mean of theirs, where
    an embedding counts only for the shards that moved it. The driver holds weights and
    sums of bounded size, never texts.

    Words and stems in fewer than ``min_texts`` texts are not learned from, as
    they would only recall single labels. A fifth of the texts, by hash, sets
    the thresholds, and all others set the weights: per language group, the threshold is the one
    with the best F1 among those of its texts, if it has 20 positives there; else that of all texts.
    """
    spark = docs.sparkSession
    encoded = staged(_labelled(docs, labels, doc_id, text, label, shard_texts), "toxicity")
    common, weights = _common(encoded, min_texts), initial(seed)
    taught = encoded.where(~F.col("kept_back")).select("shard", "words", "label", "language")
    for number in range(epochs):
        sent = spark.sparkContext.broadcast((weights, common))
        ways = taught.mapInArrow(_learn(sent, seed, number), ", ".join(f"{c} long" for c in _MOVED)).groupBy("part", "row")
        found = ways.agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in _MOVED[2:])).toArrow()
        sent.unpersist()
        weights = _moved_on(weights, found)
    model = model_of(weights)
    _calibrate(model, encoded.where("kept_back").select("shard", "words", "label", "language"))
    return model


def _learn(sent, seed: int, number: int):
    """A round of learning, one learner per shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, common = sent.value
        learner, at = None, None
        for shard, texts, labels, _ in _blocks(batches):
            if learner and shard != at:
                yield learner.moved()
                learner = None
            learner, at = learner or Learner(weights), shard
            learner.learn(_only_common(texts, common), labels, np.random.default_rng([seed, number, shard, learner.step]))
        if learner:
            yield learner.moved()

    return run


def _calibrate(model: ToxicityModel, kept_back: DataFrame) -> None:
    """Sets the thresholds by scores of texts that were not learned from, counted by steps of the score."""
    sent = kept_back.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, labels, groups in _blocks(batches):
            raw = np.concatenate([sent.value.raw_scores(texts[i : i + 256]) for i in range(0, len(texts), 256)])
            steps = np.minimum(raw * CUTS, CUTS - 1).astype(np.int64)
            columns = [pa.array(c.astype(np.int64)) for c in (groups, steps, labels)]
            yield pa.record_batch(columns, ["language", "step", "label"])

    counted = kept_back.mapInArrow(count, "language long, step long, label long")
    counted = counted.groupBy("language", "step", "label").agg(F.count("*").alias("n")).toArrow()
    sent.unpersist()
    counts = np.zeros((2, len(GROUPS), CUTS), np.int64)
    counts[tuple(counted[c].to_numpy() for c in ("label", "language", "step"))] = counted["n"].to_numpy()
    if not counts[1].any():
        return
    model.default = _best_cut(counts[1].sum(axis=0), counts[0].sum(axis=0))
    for g in range(len(GROUPS)):
        if counts[1, g].sum() >= 20:
            model.thresholds[g] = _best_cut(counts[1, g], counts[0, g])


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    block_words: int = 200_000,
) -> DataFrame:
    """(doc_id, score, predicted), one row per row of ``docs``.

    The whole text is read; only its words count. ``predicted`` is 1 from a
    score of 0.3 on, where every language group's threshold lies. Null, empty
    and wordless texts get the score of a text without words. Other columns are
    ignored; ids may repeat or be null. The plan is narrow.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, vocabulary = sent.value, Vocabulary()
        for batch in batches:
            start, held, size = 0, [], 0
            for row, value in enumerate(batch.column(1)):
                held.append(vocabulary.encode(value.as_py()))
                size += len(held[-1][0])
                if size >= block_words or row == batch.num_rows - 1:
                    raw = model.raw_scores([h[0] for h in held])
                    score = model.calibrated(raw, np.array([h[1] for h in held])).astype(np.float64)
                    ids = batch.column(0).slice(start, len(held))
                    yield pa.record_batch([ids, pa.array(score)], ["doc_id", "score"])
                    start, held, size = row + 1, [], 0

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    scored = source.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def training_labels(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Labels to learn from: crc32 of the id modulo 4 is not 2. A null id is never learned from."""
    return labels.where(remainder(doc_id, 4) != 2)
