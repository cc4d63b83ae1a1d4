"""Corpus operators against brute force, libraries and SQL, and on awkward rows."""

import base64
import hashlib
import html.parser
import json
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import TINY
from tidemark.llm import (
    bpe,
    chat_format,
    components,
    decontaminate,
    language_id,
    line_dedup,
    quality_rules,
    queries,
    simhash,
    suffixes,
    token_counts,
    toxicity,
    warc,
)

LONG = "word " * 30_000
AWKWARD = [
    (1, "One two three.\nFour five six seven.", "en", "a", 3, "x"),
    (1, "One two three.\nFour five six seven.", "en", "a", 3, "x"),
    (2, None, None, None, None, None),
    (None, "One two three.\nFour five", "en", None, 1, "y"),
    (3, "", "fr", "b", 0, "z"),
    (4, " \t\n ", "", "", 4, ""),
    (5, LONG, "en", "c", len(LONG), "l"),
    (6, "a\u0000b \U0001f600 漢字 İ ß", "de", "d", 1, "m"),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n_words string"


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, COLUMNS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{TINY}/documents.parquet")


def by_id(df, *columns):
    return {r[0]: tuple(r[1:]) if len(columns) > 1 else r[1] for r in df.select("doc_id", *columns).collect()}


# Line dedup


def test_lines_on_many_sites_go_but_first_stays(spark):
    rows = [(i, f"shared line\nown {i}\n", f"s{i % 4}", "hidden") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_lines string")
    found = {r.doc_id: r for r in line_dedup.drop_shared_lines(docs, min_sites=4).collect()}
    assert found[0].text == "shared line\nown 0\n"
    assert {found[i].text for i in range(1, 8)} == {f"own {i}\n" for i in range(1, 8)}
    assert found[3].n_lines == "hidden" and found[3].n_lines_ == 3 and found[3].n_removed == 1


@pytest.mark.parametrize("sites, gone", [(29, False), (30, True), (31, True), (60, True)])
def test_spread_near_the_threshold_is_exact(spark, sites, gone):
    docs = spark.range(sites).selectExpr("id AS doc_id", "'common text' AS text", "concat('s', id) AS source")
    removed = line_dedup.drop_shared_lines(docs, min_sites=30, lg_k=4).agg(F.sum("n_removed")).first()[0]
    assert removed == (sites - 1 if gone else 0)


def test_line_dedup_of_awkward_rows(awkward, empty):
    assert line_dedup.drop_shared_lines(empty).count() == 0
    rows = line_dedup.drop_shared_lines(awkward, min_sites=2).collect()
    assert len(rows) == len(AWKWARD)
    found = {r.doc_id: r for r in rows}
    # "One two three." stands on two sites, one of them unnamed; the null id comes first.
    assert found[1].text == "Four five six seven." and found[None].text.startswith("One two three.")
    assert found[2].text is None and found[2].n_lines == 0 and found[3].text == ""


# SimHash


def plain_simhash(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").translate(
        {ord(c): " " for c in "\t\n\v\f\r"}).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    bits = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def test_fingerprints(documents):
    texts = [r.text for r in documents.limit(40).collect()] + ["", "one", "One TWO", "a\x1cb c d e f", None]
    assert [simhash.simhash(t) for t in texts] == [plain_simhash(t) for t in texts]
    assert simhash.simhash(LONG, block=1000) == simhash.simhash(LONG)


@pytest.mark.parametrize("split_at", [100_000, 20])
def test_links_equal_all_pairs(spark, split_at):
    rng = np.random.default_rng(5)
    center = rng.integers(0, 2**62)
    near = [int(center ^ (1 << int(a)) ^ (1 << int(b))) for a, b in rng.integers(0, 40, (150, 2))]
    keys = sorted({int(x) for x in rng.integers(-(2**63), 2**63, 100)} | set(near) | {-1, 0, 1, -(2**63)})
    links = simhash.fingerprint_links(spark.createDataFrame([(k,) for k in keys], "fp long"), split_at=split_at)
    found = {r.node: r.root for r in components.component_roots(links).collect()}
    root = {k: k for k in keys}
    for a in keys:
        for b in keys:
            if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert {k: found.get(k, k) for k in keys} == root


def test_components_of_a_chain(spark):
    edges = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    assert {r.root for r in components.component_roots(edges).collect()} == {0}
    assert components.component_roots(edges.limit(0)).count() == 0


def test_near_duplicates_of_awkward_rows(awkward, empty):
    assert simhash.near_duplicate_components(empty).count() == 0
    rows = simhash.near_duplicate_components(awkward).collect()
    assert len(rows) == len(AWKWARD)
    found = {(r.doc_id, r.fp): r.component_id for r in rows}
    assert found[(2, 0)] == found[(3, 0)] == found[(4, 0)] == 2
    kept = simhash.one_per_component(awkward).collect()
    assert sum(r.doc_id == 1 for r in kept) == 1 and {r.doc_id for r in kept} >= {1, 2, 5, 6, None}
    assert not {3, 4} & {r.doc_id for r in kept}


def test_near_copies_without_ids_leave_one(spark):
    # Two texts whose fingerprints are near but not equal.
    words = [f"w{i}" for i in range(300)]
    text = " ".join(words)
    other = next(
        t
        for i in range(300)
        for t in [" ".join(words[:i] + ["other"] + words[i + 1 :])]
        if 1 <= (simhash.simhash(text) ^ simhash.simhash(t)).bit_count() <= 3
    )
    far = " ".join(f"v{i}" for i in range(300))
    docs = spark.createDataFrame([(None, t) for t in (text, other, other, far)] + [(7, text[::-1]), (7, far[::-1])], "doc_id long, text string")
    kept = simhash.one_per_component(docs).collect()
    nameless = [r.text for r in kept if r.doc_id is None]
    assert len(nameless) == 2 and far in nameless
    # One id on two unlike texts: neither is a copy of the other.
    assert sum(r.doc_id == 7 for r in kept) == 2


# Suffix arrays, quality rules


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(2)
    for _ in range(30):
        symbols = np.append(rng.integers(0, 4, 60), 0)
        order, rank, lcp = suffixes.sort_suffixes(symbols)
        gaps = iter(range(-100, 0))
        unique = [next(gaps) if s == 0 else int(s) for s in symbols]
        assert order.tolist() == sorted(range(61), key=lambda i: unique[i:])
        assert rank[order].tolist() == list(range(61))
        for k in range(1, 61):
            a, b, n = unique[order[k - 1] :], unique[order[k] :], 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            assert lcp[k] == n


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(3)
    symbols = np.append(rng.integers(0, 5, 400), 0)
    index = suffixes.FMIndex(symbols, sample=7)
    phrases = np.array([[a, b, c] for a in range(1, 7) for b in range(1, 5) for c in range(1, 5)])
    for phrase, lo, hi in zip(phrases, *index.search(phrases)):
        where = [i for i in range(len(symbols) - 2) if (symbols[i : i + 3] == phrase).all()]
        assert sorted(index.locate(np.arange(lo, hi)).tolist()) == where


def test_repeats_equal_brute_force():
    rng = random.Random(4)
    docs = [[rng.randint(1, 3) for _ in range(rng.randint(0, 40))] for _ in range(60)] + [[1] * 50]
    short, long, longest = quality_rules.repetition([np.array(d, np.int64) for d in docs], min_words=5)
    for d, s, m, top in zip(docs, short, long, longest):
        def covered(size):
            windows = [tuple(d[i : i + size]) for i in range(len(d) - size + 1)]
            return {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + size)}
        assert (s, m) == (len(covered(3)), len(covered(5)))
        assert top == max((n for n in range(1, len(d)) if covered(n)), default=0)


def test_quality_of_awkward_rows(spark, awkward, empty):
    assert quality_rules.quality_rules(empty).count() == 0
    found = {r.doc_id: r for r in quality_rules.quality_rules(awkward, batch_words=3).collect()}
    assert found[2].n_words == 0 and found[2].base_failed and not found[2].kept
    assert found[5].n_words == found[5].n_repeat_words == 30_000 and found[5].base_failed
    assert found[6].word_chars == 8
    clean = " ".join(f"w{i}" for i in range(400))
    passage = " ".join(f"p{i}" for i in range(150))
    docs = spark.createDataFrame([(1, clean), (2, f"{passage} {clean} {passage}")], "doc_id long, text string")
    assert by_id(quality_rules.quality_rules(docs), "base_failed", "kept") == {1: (False, True), 2: (False, False)}


# WARC


class Text(html.parser.HTMLParser):
    def __init__(self):
        super().__init__()
        self.hidden, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "title")
        self.out.append("\n" if tag in warc._BLOCKS else "")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "title")
        self.out.append("\n" if tag in warc._BLOCKS else "")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data.replace("\n", " "))


def test_plain_text_equals_a_parser(spark):
    pages = [r.html for r in spark.read.parquet(f"{TINY}/pages.parquet").collect()]
    pages = [p for p in pages if p.rstrip().endswith("</html>")]
    pages.append('<p title="a > b">x<b>y</b></p><!-- <p>z --><script>"</p>"</script>&eacute;&#233; 1 < 2<br>w')
    for page in pages:
        parser = Text()
        parser.feed(page)
        parser.close()
        lines = (" ".join(line.split()) for line in "".join(parser.out).split("\n"))
        assert warc.plain_text(page) == "\n".join(x for x in lines if x)


@pytest.mark.parametrize("name", ["title-bar", "template-card", "style-guide", "script:x", "noscript.y", "TITLE-Bar"])
def test_custom_elements_hide_nothing(name):
    page = f'<html-view lang=xx><html lang=en><p>a</p><{name} k=1>b</{name}><title>T</title><p>rest <a href="/x">of</a> page</p>'
    assert warc.plain_text(page) == "a\nb\nrest of page"
    assert warc.page_facts(page) == {"title": "T", "lang": "en", "links": ["/x"]}
    assert warc.plain_text("<p>a<style\ntype=x>b</style><title/>c</title >d") == "ad"


def test_derivatives_are_linked_and_written(spark, tmp_path):
    rows = [(1, "http://a/", "<html lang=fr><title>T &amp; t</title><a href='/x?a&amp;b'>é</a>"), (2, None, None), (None, "http://b/\r\n", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    source = {r.key: r for r in warc.responses(pages).collect()}
    records = warc.derivatives(warc.responses(pages))
    found = {(r.key, r.type): r for r in records.collect()}
    assert len(found) == 6
    meta, text = found[(1, "metadata")], found[(1, "conversion")]
    assert meta.refers_to == text.refers_to == source[1].record_id
    assert meta.concurrent_to == text.record_id and text.concurrent_to == meta.record_id
    assert text.block == "é" and text.content_length == 2
    digest = "sha1:" + base64.b32encode(hashlib.sha1(rows[0][2].encode()).digest()).decode()
    assert text.source_payload_digest == digest and text.block_digest == warc.digest("é".encode())
    facts = json.loads(meta.block)["Envelope"]
    assert facts["HTML"] == {"title": "T & t", "lang": "fr", "links": ["/x?a&b"]}
    assert facts["WARC-Header"]["WARC-Payload-Digest"] == digest
    assert ["Content-Type", "text/html; charset=utf-8"] in facts["HTTP-Response"]["Headers"]
    assert found[(2, "conversion")].block == ""
    warc.write_warc(records, str(tmp_path / "out"))
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    read = []
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        size = int(fields["Content-Length"])
        read.append((fields["WARC-Record-ID"], rest[:size].decode()))
        assert fields["WARC-Source-Payload-Digest"] in {r.source_payload_digest for r in found.values()}
        assert head.startswith(b"WARC/1.1") and rest[size : size + 4] == b"\r\n\r\n"
        raw = rest[size + 4 :]
    assert sorted(read) == sorted((r.record_id, r.block) for r in found.values())
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0


@pytest.mark.parametrize(
    "piece", ["<a ", "<a href=", "<html ", "<title ", "<script ", '<a "', "<a '>", "<!--", "<a href = ", " lang=", "<p>x</p>"]
)
def test_long_pages_take_linear_time(piece):
    def seconds(n):
        page = piece * n
        began = time.perf_counter()
        warc.page_facts(page)
        warc.plain_text(page)
        return time.perf_counter() - began

    seconds(1_000)
    # Quadratic work would take 64 times as long.
    assert min(seconds(160_000) for _ in range(2)) < 24 * max(min(seconds(20_000) for _ in range(3)), 0.002)


def test_attributes_are_read_tag_by_tag():
    page = '<HTML data-lang="x" lang = "pt-BR"><a title="x > href=no" HREF="/1">a</a><a name=b>b</a><A href=\'/2\' href=/3>c</a>'
    page += '<article href=/no></article><a/href=/4>d</a><a href>e</a><a data-href="/no" href="">f</a></a href="/no"><a href="/5'
    assert warc.page_facts(page)["lang"] == "pt-BR"
    assert warc.page_facts(page)["links"][:4] == ["/1", "/2", "/4", ""]


# Tokenizers


@pytest.fixture(scope="module")
def libraries():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoding, tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def odd_texts():
    rng = random.Random(3)
    letters = "ab cdE  \n\t'sre'll123²½éñ中文漢字ßΩ!?.,-_ 　\u0085\x1c\x1e\U0001f600́Ⅳᾼǅ٣"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(300)]
    return texts + ["a" * 3000, "ab'" * 700, " " * 3000, "x" * 200 + "<|endoftext|>y <|endoftext|>", "don't'll've" * 50]


@pytest.mark.parametrize("chunk, overlap", [(10**6, 10), (50, 16), (37, 4), (8, 8)])
def test_encoding_equals_library(libraries, chunk, overlap):
    encoder = bpe.Encoder("byte_bpe_50k.tiktoken")
    for text in odd_texts():
        packed = bpe.encode_text(encoder, text, chunk, overlap)
        assert np.frombuffer(packed, "<u4").tolist() == libraries[0].encode_ordinary(text)
        assert encoder.decode(packed) == text.encode()


def test_parts_of_a_text_are_encoded_by_several_tasks(spark, libraries):
    rng = random.Random(5)
    mixed = ["".join(rng.choice("ab cdE  \n\t're123é中文ßΩ!?., \U0001f600") for _ in range(n)) for n in (400, 3000, 3001)]
    # The last two have no boundary where parts overlap; one text stands three times, one is null.
    texts = [*mixed, mixed[1], mixed[1], "x" * 4000, "word " * 200 + " " * 900 + "end", "", None]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, text_key string")
    for part, overlap in ((64, 16), (500, 100), (37, 4)):
        sizes = {"spread_bytes": 300, "part": part, "part_overlap": overlap}
        found = bpe.encode_documents(docs.repartition(3), **sizes).collect()
        assert len(found) == len(texts) and found[0].asDict().keys() == {"doc_id", "ids", "text_key"}
        for row in found:
            want = libraries[0].encode_ordinary(texts[row.doc_id] or "")
            assert np.frombuffer(row.ids, "<u4").tolist() == want, (row.doc_id, part)
    key_text = docs.where("doc_id = 2").selectExpr("'k' AS key", "text")
    parts = key_text.mapInArrow(bpe._cut(64, 16), bpe._spark_schema(bpe._PART))
    assert parts.repartition(8, "key", "number").select(F.spark_partition_id()).distinct().count() > 3
    assert bpe._encode_spread(key_text, "byte_bpe_50k.tiktoken", 64, 16).where("ids IS NOT NULL").count() == 1


def test_counts_equal_library(libraries):
    counter = token_counts.TokenCounter("byte_bpe_50k.json", cache_size=50)
    for text in odd_texts():
        assert counter.count(text) == len(libraries[1].encode(text, add_special_tokens=False).ids)


def test_all_kinds_of_characters(libraries):
    encoder, counter = bpe.Encoder("byte_bpe_50k.tiktoken"), token_counts.TokenCounter("byte_bpe_50k.json")
    newer = [0x1C89, 0xA7CB, 0xA7DC, 0x105C0, 0x10D4A, 0x2EBF0, 0x208F, 0x10940]
    for c in [*range(0x3000), *range(0x3000, 0x110000, 61), *newer]:
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}b {chr(c)}{chr(c)}1{chr(c)} !{chr(c)}  {chr(c)}'s{chr(c)}"
            packed = bpe.encode_text(encoder, text, 16_384, 512)
            assert np.frombuffer(packed, "<u4").tolist() == libraries[0].encode_ordinary(text), hex(c)
            assert counter.count(text) == len(libraries[1].encode(text, add_special_tokens=False).ids), hex(c)


def test_token_queries(spark, libraries, documents, awkward, empty):
    texts = by_id(documents, "text")
    for doc, (n, ids, raw) in by_id(bpe.encoding_digests(documents), "n_tokens", "ids_sha256", "decoded_sha256").items():
        want = libraries[0].encode_ordinary(texts[doc])
        assert n == len(want) and ids == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert raw == hashlib.sha256(texts[doc].encode()).hexdigest()
    for doc, (size, n, over) in by_id(token_counts.token_counts(documents), "n_bytes", "n_tokens", "over_limit").items():
        want = len(libraries[1].encode(texts[doc], add_special_tokens=False).ids)
        assert (size, n, over) == (len(texts[doc].encode()), want, want > 1024)
    nothing = hashlib.sha256(b"").hexdigest()
    assert by_id(bpe.encoding_digests(awkward), "n_tokens", "ids_sha256")[2] == (0, nothing)
    assert by_id(token_counts.token_counts(awkward), "n_bytes", "n_tokens")[2] == (0, 0)
    assert bpe.encoding_digests(empty).count() == token_counts.token_counts(empty).count() == 0


@pytest.mark.parametrize("name", ["op2_simhash", "op5_byte_bpe", "op6_toxicity", "op9_token_counts", "op10_language_id"])
def test_every_document_has_one_row(spark, name):
    found = queries.QUERIES[name](spark, TINY).select("doc_id")
    whole = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id")
    assert found.count() == whole.count() > 0
    assert found.exceptAll(whole).isEmpty()


# Toxicity


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = queries.toxicity_query(spark, folder).join(labels, "doc_id").where("held_out").toPandas()
    rank = found.score.rank()
    ones = found.toxic.sum()
    area = (rank[found.toxic == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(found) - ones))
    assert area > 0.93
    assert found.predicted[found.toxic == 1].mean() > 0.75 and found.predicted[found.toxic == 0].mean() < 0.02
    assert ((found.score >= 0.3) == (found.predicted == 1)).all() and found.score.between(0, 1).all()


def test_toxicity_scores_by_plain_loops():
    rng = np.random.default_rng(3)
    wide = 2 * toxicity.WIDTH
    tables = [rng.normal(size=(toxicity.TABLE, toxicity.WIDTH)) for _ in range(2)]
    tables[0][0] = tables[1][0] = 0
    filters = [rng.normal(size=(n, wide, toxicity.FILTERS)) for n in toxicity.SIZES]
    kinds = len(filters) * toxicity.FILTERS
    model = toxicity.ToxicityModel(*tables, filters, rng.normal(size=kinds), rng.normal(size=kinds) / 9, 0.1)
    texts = ["", "one", "a b c d", "ein Wort und noch ein Wort", "x y", ""]
    rows = [toxicity.Vocabulary().encode(t)[0] for t in texts]

    def score(words):
        vectors = [[*tables[0][w // toxicity.TABLE], *tables[1][w % toxicity.TABLE]] for w in words]
        vectors += [[0.0] * wide] * max(toxicity.SIZES)
        total, unit = 0.1, 0
        for size, kernel in zip(toxicity.SIZES, filters):
            for f in range(toxicity.FILTERS):
                best = max(
                    sum(vectors[i + t][d] * kernel[t][d][f] for t in range(size) for d in range(wide))
                    for i in range(len(vectors) - size + 1)
                )
                total += max(best + model.bias[unit], 0) * model.out[unit]
                unit += 1
        return 1 / (1 + np.exp(-min(max(total, -30), 30)))

    assert np.allclose(model.raw_scores(rows), [score(r) for r in rows])
    # A score does not depend on the texts around it.
    alone = np.concatenate([model.raw_scores([r]) for r in rows])
    assert np.allclose(model.raw_scores(rows[::-1])[::-1], alone)


def test_toxicity_learns_from_every_labelled_text(spark):
    rng = random.Random(5)
    # Every text has a mark, of its kind and number; the toxic ones have it behind 60,000 characters.
    plain = [" ".join(rng.choices(["lorem", "ipsum", "dolor", "sit"], k=12)) for _ in range(400)]
    marks = ["vile" if i % 2 else "kind" for i in range(400)]
    rows = [(i, f"{t} {'pad ' * (15_000 if i % 40 == 1 else 0)}{m}{i % 50}", i % 2) for i, (t, m) in enumerate(zip(plain, marks))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(5)
    labels = docs.select("doc_id", "toxic")
    encoded = toxicity._labelled(docs, labels, "doc_id", "text", "toxic", 64)
    found = encoded.selectExpr("count(*) AS n", "count(DISTINCT shard) AS shards", "max(octet_length(words)) AS longest").first()
    assert found.n == 400 and found.shards == 7 and found.longest == 8 * 15_013
    models = [toxicity.fit_toxicity(d, labels, shard_texts=64) for d in (docs, docs.repartition(2))]
    scored = toxicity.score_toxicity(docs, models[0]).join(labels, "doc_id").toPandas()
    assert (scored.predicted == scored.toxic).mean() > 0.97
    # Neither partitions nor their order count.
    assert all(np.array_equal(getattr(models[0], c), getattr(models[1], c)) for c in ("first", "second", "out", "bias"))
    assert models[0].thresholds == models[1].thresholds and models[0].default == models[1].default


def test_toxicity_thresholds_have_the_best_f1():
    rng = np.random.default_rng(2)
    steps, labels = rng.integers(0, toxicity.CUTS, 300), rng.integers(0, 2, 300)
    counts = [np.bincount(steps[labels == n], minlength=toxicity.CUTS) for n in (1, 0)]
    def f1(cut):
        drawn = (steps + 0.5) / toxicity.CUTS >= cut
        return 2 * (drawn & (labels == 1)).sum() / (drawn.sum() + labels.sum())

    best = max(f1((s + 0.5) / toxicity.CUTS) for s in steps)
    assert f1(toxicity._best_cut(*counts)) == best


@pytest.mark.parametrize("piece", [3, 4, 1 << 16])
def test_toxicity_windows_of_long_texts(monkeypatch, piece):
    rng = np.random.default_rng(1)
    model = toxicity.model_of(toxicity.initial(3) | {"first": rng.normal(size=(toxicity.TABLE, toxicity.WIDTH))})
    texts = [rng.integers(1, 50, n) * toxicity.TABLE + rng.integers(1, 50, n) for n in (0, 1, 2, 3, 4, 5, 9, 40)]
    monkeypatch.setattr(toxicity, "PIECE", piece)
    pooled, windows = toxicity.winners(model, texts)
    assert np.allclose(model.probability(pooled), model.raw_scores(texts), atol=1e-5)
    for k, (size, found) in enumerate(zip(toxicity.SIZES, windows)):
        vectors = model.embed(found.ravel()).reshape(*found.shape, -1)
        again = np.einsum("ntfd,tdf->nf", vectors, model.filters[k])
        assert np.allclose(again, pooled[:, k * toxicity.FILTERS : (k + 1) * toxicity.FILTERS], atol=1e-5)


def test_toxicity_of_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(awkward, labels)
    rows = toxicity.score_toxicity(awkward, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_toxicity(empty, model).count() == 0
    untaught = toxicity.fit_toxicity(empty, labels.limit(0))
    assert toxicity.score_toxicity(awkward, untaught).count() == len(AWKWARD)


# Decontamination


def test_passages_of_awkward_rows(spark, awkward, empty):
    bench = spark.createDataFrame(
        [(1, "two THREE four"), (2, None), (None, "b 漢字"), (3, "..."), (1, "word word word word word word word word word word word")],
        "item_id long, text string",
    )
    found = {r.doc_id: r for r in decontaminate.find_passages(awkward, bench, shard=64).collect()}
    assert found[1]["n_words"] == "x" and found[1].spans == [1, 4] and found[1]["items"] == ["1"]
    assert found[5].spans == [0, 30_000] and found[2].spans == [] and found[2].n_words_ == 0
    in_blocks = {r.doc_id: r for r in decontaminate.find_passages(awkward, bench, block_words=1).collect()}
    assert in_blocks == found
    assert decontaminate.find_passages(empty, bench).count() == 0
    assert decontaminate.find_passages(awkward, bench.limit(0)).where("size(spans) > 0").count() == 0
    cut = by_id(decontaminate.remove_passages(awkward, bench), "text")
    assert cut[1] == "One  five six seven." and cut[2] is None and cut[3] == ""


# Chat


def test_snapshots_collapse(spark):
    def conv(c, *texts):
        return [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]

    rows = conv(5, "a") + conv(4, "a", "b") + conv(3, "a", "b", "c") + conv(2, "a", "b", "c") + conv(9, "a", "x")
    rows += conv(7, "b", "c") + conv(5, "a") + [(None, 0, "user", "a"), (8, None, None, None)]
    frame = spark.createDataFrame([(*r, "k") for r in rows], "conv_id long, turn long, role string, text string, k string")
    found = {r.conv_id: r for r in chat_format.render_conversations(frame).collect()}
    assert set(found) == {2, 9, 7, 8}
    assert found[9].rendered == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"
    assert found[2].n_turns == 3 and found[8].rendered == "<|im_start|>\n<|im_end|>\n"
    assert chat_format.render_conversations(frame.limit(0)).count() == 0


def chat_sql(rows):
    import duckdb

    connection = duckdb.connect()
    connection.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    connection.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(connection.execute(chat_format.CHAT_SQL).fetchall())


@pytest.mark.parametrize("shift", [9, 0, 1])
def test_chats_equal_their_sql(spark, monkeypatch, shift):
    monkeypatch.setattr(chat_format, "SHIFT", shift)
    # Three first turns of one number, and conversations that hold one of them each.
    rows = [(1, 0, "user", x) for x in "cab"] + [(i, 0, "user", x) for i, x in ((2, "a"), (3, "b"), (4, "c"))]
    rng = random.Random(shift)
    for conv in range(10, 60):
        n = rng.randint(1, 5)
        rows += [(conv, rng.choice([None, 0, 1, 1, 2]), rng.choice(["user", "assistant", None]), rng.choice(["x", "y", None])) for _ in range(n)]
    long = [(0, t, "user", f"t{t}") for t in range(1_500)]
    rows += rows[:10] + long + [(5, *turn[1:]) for turn in long[:1_100]] + [(6, *turn[1:]) for turn in long[:1_100]] + [(6, 9_999, "user", "z")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = sorted(map(tuple, chat_format.render_conversations(frame).collect()))
    assert found == chat_sql(rows)
    assert {0, 6} <= {r[0] for r in found} and 5 not in {r[0] for r in found}


# Language


def test_languages_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    langs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = queries.language_query(spark, folder).where("held_out").join(langs, "doc_id").toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.97 and found.score.between(0, 1).all()


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(6)
    model = language_id.LanguageModel(["a", "b", "c"], np.zeros((1, 3)), np.ones((1, 3), bool), penalty=1.5)
    sizes = [4, 0, 6, 1]
    scores = rng.normal(size=(sum(sizes), 3)).astype(np.float32)
    words = language_id.Words(np.repeat(np.arange(4), sizes), *[None] * 6)
    labels, start = model.label(words, scores, 4), 0
    for n in sizes:
        own = scores[start : start + n]

        def total(path):
            return sum(own[t, p] for t, p in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))

        paths = [tuple(int(x) for x in np.unravel_index(i, (3,) * n)) for i in range(3**n)] if n else [()]
        assert total(labels[start : start + n]) == pytest.approx(max(map(total, paths)), abs=1e-4)
        start += n


def test_languages_of_awkward_rows(spark, documents, awkward, empty):
    model = language_id.fit_language_model(language_id.training_rows(documents))
    found = by_id(language_id.predict_language(awkward, model), "lang_pred", "score")
    assert found[2] == found[3] == found[4] == ("und", 0.0) and found[1][0] == "en"
    assert found[6][0] in model.languages
    assert language_id.predict_language(empty, model).count() == 0
    marks = spark.createDataFrame([(1, "\u0301 \u0302"), (2, "12 \u0301a"), (3, "12 ?!")], "doc_id int, text string")
    named = by_id(language_id.predict_language(marks, model), "lang_pred", "score")
    assert named[1] == named[3] == ("und", 0.0) and named[2][0] in model.languages
    assert language_id.keep_identified(marks, model, min_score=0.0).count() == 1
    mixed = "The and was with this of that. De les des une que pour dans. Der die nicht und von eine."
    spans = language_id.language_spans(spark.createDataFrame([(1, mixed)], "doc_id int, text string"), model)
    assert [s.lang for s in spans.first().spans] == ["en", "fr", "de"]
    untaught = language_id.fit_language_model(empty)
    assert {r.lang_pred for r in language_id.predict_language(awkward, untaught).collect()} == {"und"}


@pytest.mark.parametrize("order", [1, -1])
def test_a_language_without_letters(spark, order):
    rows = [(1, "hello there world", "en"), (2, "123 456", "xx"), (3, "", "yy"), (4, "bonjour le monde", "fr")]
    docs = spark.createDataFrame(rows[::order], "doc_id long, text string, lang string").coalesce(1)
    model = language_id.fit_language_model(docs)
    assert model.languages == ["en", "fr"]
    found = by_id(language_id.predict_language(docs, model), "lang_pred")
    assert found == {1: "en", 2: "und", 3: "und", 4: "fr"}


def test_long_texts_are_labelled_in_portions(documents, monkeypatch):
    model = language_id.fit_language_model(documents.where("lang in ('en', 'fr', 'de')"))
    texts = [r.text for r in documents.where("lang in ('en', 'fr')").orderBy("doc_id").limit(40).collect()]
    long = " ".join(texts[::2]) + "\n" + " ".join(texts[1::2])
    whole, spans = language_id._verdicts(model, [long]), language_id._spans(model, [long])
    monkeypatch.setattr(language_id, "BLOCK_CELLS", 4 * 1_000)
    parts = list(language_id._portions([long], 1_000))
    assert len(parts) > 5 and "".join(p[0] for p in parts) == long
    names, score, certainty = language_id._verdicts(model, [long])
    assert names == whole[0] and np.allclose([score, certainty], whole[1:], atol=1e-5)
    assert language_id._spans(model, [long]) == spans
    assert language_id._verdicts(model, ["x" * 5_000])[0][0] in model.languages


def test_copies_do_not_crowd_out_languages(spark):
    rng = random.Random(8)
    prose = {x: [" ".join("".join(rng.choice(x) for _ in range(4)) for _ in range(30)) for _ in range(20)] for x in ("abcd", "efgh")}
    once = [(t, x) for x, texts in prose.items() for t in texts]
    copied = once + [(t, "abcd") for t in prose["abcd"] for _ in range(200)]

    def fit(rows, **limit):
        return language_id.fit_language_model(spark.createDataFrame(rows, "text string, lang string"), **limit)

    # At most 20 texts a language: all of them are drawn, and copies do not count.
    a, b = fit(once, max_rows_per_language=20), fit(copied, max_rows_per_language=20)
    assert a.languages == b.languages == ["abcd", "efgh"] and (a.weights == b.weights).all()


# Pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, TINY)
        assert docs.columns == columns, name
        if name == "language_id":
            assert docs.count() == before.where("text rlike '\\\\p{L}'").count()
        if name == "simhash":
            groups = simhash.near_duplicate_components(before).select("component_id").distinct()
            assert sorted(r.doc_id for r in docs.collect()) == sorted(r.component_id for r in groups.collect())
        if name == "decontamination":
            bench = spark.read.parquet(f"{TINY}/benchmark.parquet")
            assert docs.count() == before.count()
            assert decontaminate.find_passages(docs, bench).where("size(spans) > 0").count() == 0
    done = corpus_pipeline.run(spark, TINY)
    assert done.where("NOT round_trip").count() == 0 and done.count() == docs.count()


def test_evenly_mixed_documents_stay(spark):
    rng = random.Random(7)
    alphabets = ["abcd", "efgh", "ijkl", "mnop", "qrst", "uvwx"]

    def prose(letters, n=40):
        return " ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(n))

    rows = [(i, prose(alphabets[i % 6]), f"l{i % 6}", "s", 199) for i in range(120)]
    rows += [(120 + k, " ".join(map(prose, alphabets[: k + 1])), None, "s", 1) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = language_id.fit_language_model(language_id.training_rows(docs))
    scores = by_id(language_id.predict_language(docs, model), "score")
    assert scores[125] < corpus_pipeline.MIN_LANGUAGE_SCORE
    kept = corpus_pipeline.identify_language(spark, docs, TINY)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(126))


def test_pipeline_of_awkward_rows(spark, awkward, empty):
    for rows in (awkward, empty):
        docs = rows
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, TINY)
        assert docs.count() <= rows.count()
