"""Language spans of mixed texts: script ranges, word scores, Viterbi."""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import remainder, staged

UNDETERMINED = "und"

#: Code point ranges of scripts; all other letters are one more script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x250, 0x2FF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)],
}

BUCKETS = 1 << 15
#: Numbers (characters x languages) that are scored at once; bounds a task's memory.
BLOCK_CELLS = 1_000_000
#: So many languages at most make a table that is broadcast.
FEW_LANGUAGES = 1_000


@functools.cache
def _script_table() -> np.ndarray:
    """Script number of every code point: 0 for what is no letter or mark."""
    table = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] in "LM":
            table[c] = len(SCRIPTS) + 1
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            part = table[a : b + 1]
            part[part > 0] = number
    return table


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """Bucket of a hashed feature."""
    x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return (x * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(49)).astype(np.int32)


@dataclass
class Words:
    """Words of several texts: where they lie, and their features' buckets."""

    doc: np.ndarray  # text of each word
    start: np.ndarray  # first character within its text
    length: np.ndarray
    script: np.ndarray
    features: np.ndarray  # (n letters, 3) buckets, letters of a word together
    whole: np.ndarray  # bucket of the whole word
    first: np.ndarray  # each word's first row in features


def words_of(texts: list[str | None]) -> Words:
    """Maximal runs of letters and marks, lower-cased, with n-gram features.

    Each letter gives the one-, two- and three-letter group that ends at its
    right neighbour, with a boundary around words; the word itself is one more.
    """
    lowered = [_lower(t or "") for t in texts]
    joined = "\n" + "\n".join(lowered) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    script = _script_table()[codes]
    letter = script > 0
    c = np.where(letter, codes, 0).astype(np.uint64)
    edge = np.diff(letter.astype(np.int8))
    begin, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    offsets = 1 + np.concatenate([[0], np.cumsum([len(t) + 1 for t in lowered])]).astype(np.int64)
    doc = np.searchsorted(offsets, begin, side="right") - 1
    at = np.flatnonzero(letter)
    left, mid, right = c[at - 1], c[at], c[at + 1]
    shift = np.uint64(21)
    features = np.stack([_mix(mid, 1), _mix(left << shift | mid, 2), _mix((left << shift | mid) << shift | right, 3)], 1)
    size = end - begin
    first = np.cumsum(size) - size
    place = np.arange(len(at)) - np.repeat(first, size)
    # (c + 1) * odd ** place, wrapping: equal words get equal sums.
    powers = np.full(int(size.max(initial=0)) + 1, 0x100000001B3, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    whole = np.add.reduceat((mid + np.uint64(1)) * powers[place], first) if len(at) else np.zeros(0, np.uint64)
    return Words(doc, begin - offsets[doc], size, script[begin], features, _mix(whole, 4), first)


def _lower(text: str) -> str:
    """Lower case that keeps every character's place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


@dataclass
class LanguageModel:
    """Languages, feature weights (bucket, language), and scripts each language uses."""

    languages: list[str]
    weights: np.ndarray
    scripts: np.ndarray
    penalty: float = 10.0

    def word_scores(self, words: Words) -> np.ndarray:
        """(word, language) scores; languages that do not use a word's script score very low."""
        letters = self.weights[words.features[:, 0]] + self.weights[words.features[:, 1]]
        letters += self.weights[words.features[:, 2]]
        scores = np.add.reduceat(letters, words.first, axis=0) + 2 * self.weights[words.whole]
        allowed = self.scripts[words.script]
        return np.where(allowed | ~allowed.any(axis=1, keepdims=True), scores, -1e4)

    def label(self, words: Words, scores: np.ndarray, n_docs: int) -> np.ndarray:
        """Most likely language of every word, by Viterbi over the words of each text.

        Changing the language between two words costs ``penalty``. All texts are
        walked at once, the t-th words of texts with more than t words together.
        """
        best = np.zeros((n_docs, scores.shape[1]), np.float32)
        stay, top = self.forward(words, scores, best)
        return self.backward(words, stay, top, best.argmax(axis=1))

    def forward(self, words: Words, scores: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Walks on from ``best``, (text, language), which is brought up to the last words.

        Returns for every word which languages are best reached from themselves,
        and from which language the others are.
        """
        stay, top = np.empty(scores.shape, bool), np.empty(len(scores), np.int16)
        for at, rows in _steps(words, len(best)):
            state = best[rows]
            lead = state.argmax(axis=1)
            switched = state[np.arange(len(rows)), lead] - self.penalty
            stay[at] = state >= switched[:, None]
            top[at] = lead
            best[rows] = np.maximum(state, switched[:, None]) + scores[at]
        return stay, top

    def backward(self, words: Words, stay: np.ndarray, top: np.ndarray, now: np.ndarray) -> np.ndarray:
        """Labels of the words; ``now``, the languages after them, becomes those before."""
        labels = np.empty(len(top), np.int16)
        for at, rows in reversed(list(_steps(words, len(now)))):
            own = now[rows]
            labels[at] = own
            now[rows] = np.where(stay[at, own], own, top[at])
        return labels


def _steps(words: Words, n_docs: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, texts): the first words of all texts, then the second ones, and so on."""
    n_words = np.bincount(words.doc, minlength=n_docs)
    start = np.cumsum(n_words) - n_words
    by_size = np.argsort(-n_words, kind="stable")
    sizes, start = n_words[by_size], start[by_size]
    open_ = np.searchsorted(-sizes, -np.arange(int(sizes.max(initial=0))), side="left")
    for t, n in enumerate(open_.tolist()):
        yield start[:n] + t, by_size[:n]


def fit_language_model(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    max_rows_per_language: int = 2_000,
    penalty: float = 10.0,
) -> LanguageModel:
    """Model from a bounded sample of the labelled rows of ``docs``.

    Of each language about ``max_rows_per_language`` different texts are drawn by
    hash, and each counts once, however many copies it has; rows whose text or
    language is null are not used. Features are counted
    in tasks and summed per language and bucket, so the driver receives at most
    ``BUCKETS`` numbers a language. Weights are log-likelihoods against the mean
    of all languages. A language uses a script if it has 1 % of its letters in it.
    """
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    rows = rows.select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.xxhash64(text).alias("text_hash")
    )
    # Only hashes are shuffled for this, and below only the texts that are drawn.
    sizes = staged(rows.select("lang", "text_hash").distinct().groupBy("lang").count(), "language-sizes")
    if len(sizes.take(FEW_LANGUAGES + 1)) <= FEW_LANGUAGES:
        sizes = F.broadcast(sizes)
    drawn = (
        rows.join(sizes, "lang")
        .where(F.pmod("text_hash", F.lit(1_000_000)) * F.col("count") < max_rows_per_language * 1_000_000)
        .groupBy("lang", "text_hash")
        .agg(F.min("text").alias("text"))
        .select("text", "lang")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = np.array(batch.column(1).to_pylist(), object)
            for places, texts in _blocks(batch.column(0), BLOCK_CELLS // 4):
                langs = every[places]
                for lang in sorted(set(langs)):
                    counts, scripts = np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPTS) + 2, np.int64)
                    for own in _portions([t for t, of in zip(texts, langs) if of == lang], BLOCK_CELLS // 4):
                        found = words_of(own)
                        counts += np.bincount(found.features.ravel(), minlength=BUCKETS)
                        counts += np.bincount(found.whole, minlength=BUCKETS)
                        scripts += np.bincount(found.script, found.length, len(SCRIPTS) + 2).astype(np.int64)
                    keys = np.concatenate([np.flatnonzero(counts), -1 - np.flatnonzero(scripts)])
                    values = np.concatenate([counts[counts > 0], scripts[scripts > 0]])
                    # A language without letters in these texts gives no rows, but columns of the same types.
                    columns = [pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.int64())]
                    yield pa.record_batch([*columns, pa.array(values, pa.int64())], ["lang", "key", "n"])

    counted = drawn.mapInArrow(run, "lang string, key long, n long")
    table = counted.groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(table.column("lang").to_pylist(), object)
    languages = sorted(set(names.tolist()))
    index = np.searchsorted(languages, names) if languages else np.zeros(0, int)
    key, n = table.column("key").to_numpy(), table.column("n").to_numpy()
    counts = np.zeros((BUCKETS, max(1, len(languages))))
    counts[key[key >= 0], index[key >= 0]] = n[key >= 0]
    letters = np.zeros((len(SCRIPTS) + 2, max(1, len(languages))))
    letters[-1 - key[key < 0], index[key < 0]] = n[key < 0]
    smooth = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * BUCKETS))
    weights = (smooth - smooth.mean(axis=1, keepdims=True)) / 3
    scripts = letters >= np.maximum(1, 0.01 * letters.sum(axis=0))
    return LanguageModel(languages, weights.astype(np.float32), scripts, penalty)


def _block_chars(model: LanguageModel) -> int:
    return BLOCK_CELLS // max(4, len(model.languages))


def _certainty(scores: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """How clearly each word speaks for its label."""
    chance = np.exp(scores - scores.max(axis=1, keepdims=True))
    return chance[np.arange(len(labels)), labels] / chance.sum(axis=1)


def _tally(model: LanguageModel, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text, language): letters labelled with each language, and the same weighed by certainty."""
    size = len(model.languages)
    letters, trust = np.zeros((2, len(texts) * size))
    for words, labels, scores, _ in _labelled(model, texts):
        cell = words.doc * size + labels
        letters += np.bincount(cell, words.length, minlength=len(letters))
        trust += np.bincount(cell, words.length * _certainty(scores, labels), minlength=len(trust))
    return letters.reshape(-1, size), trust.reshape(-1, size)


def _labelled(model: LanguageModel, texts: list[str | None]):
    """(words, labels, scores, offset) of all texts of a block, or portion by portion of one long text.

    A long text is walked forward portion by portion, keeping a bit per word and
    language, then back; its words are scored once more with the labels known.
    """
    size = _block_chars(model)
    if len(texts) > 1 or len(texts[0] or "") <= size:
        words = words_of(texts)
        if len(words.doc):
            scores = model.word_scores(words)
            yield words, model.label(words, scores, len(texts)), scores, 0
        return
    best, kept = np.zeros((1, len(model.languages)), np.float32), []
    for portion in _portions(texts, size):
        words = words_of(portion)
        stay, top = model.forward(words, model.word_scores(words), best) if len(words.doc) else (None, None)
        kept.append(None if stay is None else (np.packbits(stay, axis=1), top))
    now, labels = best.argmax(axis=1), []
    for place in range(len(kept) - 1, -1, -1):
        if kept[place]:
            bits, top = kept[place]
            stay = np.unpackbits(bits, axis=1, count=len(model.languages)).astype(bool)
            steps = Words(np.zeros(len(top), np.int64), *[None] * 6)
            labels.append(model.backward(steps, stay, top, now))
    offset = 0
    for portion in _portions(texts, size):
        words = words_of(portion)
        if len(words.doc):
            yield words, labels.pop(), model.word_scores(words), offset
        offset += len(portion[0])


def _portions(texts: list[str | None], size: int) -> Iterator[list[str | None]]:
    """``texts`` as they are, but a single longer one in portions that end between words.

    A run of more letters than ``size`` is cut, and counts as several words.
    """
    if len(texts) != 1 or len(texts[0] or "") <= size:
        yield texts
        return
    text, table, start = texts[0], _script_table(), 0
    while start < len(text):
        stop = min(start + size, len(text))
        end = stop
        while end < len(text) and end > start and table[ord(text[end - 1])] and table[ord(text[end])]:
            end -= 1
        stop = end if end > start else stop
        yield [text[start:stop]]
        start = stop


def _verdicts(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Per text language, score, and certainty of all its words together."""
    if not model.languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    letters, trust = _tally(model, texts)
    top = letters.argmax(axis=1)
    total = letters.sum(axis=1)
    score = trust[np.arange(len(texts)), top] / np.maximum(total, 1)
    certainty = trust.sum(axis=1) / np.maximum(total, 1)
    # Marks alone make words, but no letters.
    named = np.array([bool(n) and any(map(str.isalpha, t)) for n, t in zip(total.tolist(), texts)], bool)
    names = [model.languages[i] if any_ else UNDETERMINED for i, any_ in zip(top.tolist(), named.tolist())]
    return names, *(np.where(named, np.clip(x, 0, 1), 0.0) for x in (score, certainty))


def _spans(model: LanguageModel, texts: list[str | None]) -> list[list[dict]]:
    """Per text its stretches of one language."""
    out: list[list[dict]] = [[] for _ in texts]
    for words, labels, _, offset in _labelled(model, texts) if model.languages else ():
        new = np.ones(len(labels), bool)
        new[1:] = (np.diff(labels) != 0) | (np.diff(words.doc) != 0)
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(labels)) - 1
        for d, a, b, label in zip(
            words.doc[begin].tolist(),
            (words.start[begin] + offset).tolist(),
            ((words.start + words.length)[last] + offset).tolist(),
            labels[begin].tolist(),
        ):
            lang, own = model.languages[label], out[d]
            if offset and own and own[-1]["lang"] == lang:
                own[-1]["end"] = b
            else:
                own.append({"start": a, "end": b, "lang": lang})
    return out


def _blocks(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, list[str | None]]]:
    """(places, texts): blocks of about ``size`` characters, texts of like length together, longer ones alone."""
    lengths = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(lengths, kind="stable")
    begin, held = 0, 0
    for end, length in enumerate(lengths[order].tolist()):
        if held and held + length > size:
            yield order[begin:end], [column[i].as_py() for i in order[begin:end].tolist()]
            begin, held = end, 0
        held += length
    if len(order):
        yield order[begin:], [column[i].as_py() for i in order[begin:].tolist()]
    pa.default_memory_pool().release_unused()


def _named(model: LanguageModel, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_verdicts`` of all texts of a batch."""
    names, score, certainty = np.empty(len(column), object), np.zeros(len(column)), np.zeros(len(column))
    for places, texts in _blocks(column, _block_chars(model)):
        names[places], score[places], certainty[places] = _verdicts(model, texts)
    return names, score, certainty


def _name_texts(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score, _ = _named(model, batch.column(0))
            found = [pa.array(names, pa.string()), pa.array(score, pa.float64())]
            yield pa.record_batch([*batch.columns[1:], *found], [*batch.schema.names[1:], "lang_pred", "score"])

    return run


def predict_language(docs: DataFrame, model: LanguageModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of ``docs``.

    ``lang_pred`` is the language with the most letters in the spans found, and
    ``und`` for texts that are null or have no letter, or if nothing was learned;
    the first language by name wins ties. ``score`` is its share of the letters,
    each weighed by how clearly its word speaks for it (0 for ``und``). Other
    columns are ignored; repeated rows give repeated results.
    """
    source = docs.select(F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_name_texts(model), f"doc_id {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, *, text: str = "text", min_score: float) -> DataFrame:
    """Rows of ``docs``, all columns, whose words speak for their languages with at least ``min_score``.

    Every letter counts with how clearly its word speaks for the language of its
    span, whichever that is, so a text does not go for being mixed. Rows that
    ``predict_language`` would call ``und`` go.
    """
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, _, certainty = _named(model, batch.column(at))
            yield batch.filter(pa.array((certainty >= min_score) & (names != UNDETERMINED), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def language_spans(docs: DataFrame, model: LanguageModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans): stretches of one language with start, end (characters) and lang.

    Texts without letters have no spans.
    """
    kind = "array<struct<start:bigint,end:bigint,lang:string>>"
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.empty(batch.num_rows, object)
            for places, texts in _blocks(batch.column(0), _block_chars(model)):
                for place, spans in zip(places.tolist(), _spans(model, texts)):
                    found[place] = spans
            yield pa.record_batch([batch.column(1), pa.array(found.tolist(), arrow)], ["doc_id", "spans"])

    source = docs.select(F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, spans {kind}")


def training_rows(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows to learn from: crc32 of the id modulo 5 is not 0. A null id is never learned from."""
    return docs.where(remainder(doc_id, 5) != 0)
