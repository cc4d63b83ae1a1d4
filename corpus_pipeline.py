"""Corpus pipeline: every stage filters or rewrites what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, language_id, line_dedup, simhash
from tidemark.llm.common import staged, unused
from tidemark.llm.queries import table

#: Documents go only if their words speak for no language at all; mixed ones stay,
#: as the certainty of the words is summed over all languages in a document.
MIN_LANGUAGE_SCORE = 0.2


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars as long as the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters or a clear language go.

    ``lang`` stays what it was; the model learns from it.
    """
    table(spark, sf_dir, "documents")
    model = language_id.fit_language_model(language_id.training_rows(docs))
    return language_id.keep_identified(docs, model, min_score=MIN_LANGUAGE_SCORE)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site lines; those that consisted of nothing else go."""
    lines, removed = unused(docs, "n_lines", "n_removed")
    cleaned = line_dedup.drop_shared_lines(docs)
    emptied = (F.col(removed) > 0) & (F.trim("text") == "")
    return _counted(cleaned.where(~F.coalesce(emptied, F.lit(False))).drop(lines, removed))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return simhash.one_per_component(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark passages in them."""
    return _counted(decontaminate.remove_passages(docs, table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, token ids, and whether they decode to the text."""
    source = docs.select("doc_id", "lang", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("was"), "text")
    encoded = bpe.encode_documents(source).withColumn("packed", F.col("ids"))
    decoded = bpe.decode_documents(encoded)
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("packed") / 4).cast("long").alias("n_tokens"),
        F.col("packed").alias("ids"),
        (F.sha2("raw", 256) == F.col("was")).alias("round_trip"),
    )


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("simhash", drop_near_duplicates),
    ("decontamination", remove_benchmark),
    ("byte_bpe", encode),
]

#: Language identification cannot be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
