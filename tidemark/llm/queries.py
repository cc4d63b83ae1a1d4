"""One query per corpus operator, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    chat_format,
    decontaminate,
    language_id,
    line_dedup,
    periodic_runs,
    quality_rules,
    simhash,
    structure_repair,
    token_counts,
    topk_search,
    toxicity,
    warc,
)
from tidemark.llm.common import remainder


BATCH_BYTES = str(8 << 20)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # Python workers import this package; in local mode they look where the driver does.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    # Texts come to Python in batches of this size, or one longer text alone: a batch is
    # held by the JVM and the worker, on its way in and out.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def line_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return line_dedup.drop_shared_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


def simhash_query(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicate_components(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def quality_query(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, folder, "documents")).drop("longest_repeat")


def warc_query(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.derivatives(warc.responses(table(spark, folder, "pages")))
    return records.withColumnRenamed("key", "page_id")


def bpe_query(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, folder, "documents"))


def toxicity_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = toxicity.training_labels(table(spark, folder, "labels"))
    model = toxicity.fit_toxicity(docs, labels)
    scored = toxicity.score_toxicity(docs, model)
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def decontamination_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, table(spark, folder, "benchmark"))
    hit = F.expr("aggregate(sequence(0, size(spans) - 1), 0L, (n, i) -> n + if(i % 2 = 1, spans[i], -spans[i]))")
    n_hit = F.when(F.size("spans") > 0, hit).otherwise(F.lit(0).cast("long"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def chat_query(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.render_conversations(table(spark, folder, "conversations"))


def token_count_query(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


def language_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_id.fit_language_model(language_id.training_rows(docs))
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return language_id.predict_language(docs, model).withColumn("held_out", held_out)


def topk_query(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def runs_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = periodic_runs.cycled_tails(table(spark, folder, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


def repair_query(spark: SparkSession, folder: str) -> DataFrame:
    return structure_repair.repair_query(table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": line_dedup_query,
    "op2_simhash": simhash_query,
    "op3_quality_rules": quality_query,
    "op4_warc": warc_query,
    "op5_byte_bpe": bpe_query,
    "op6_toxicity": toxicity_query,
    "op7_decontamination": decontamination_query,
    "op8_chat_format": chat_query,
    "op9_token_counts": token_count_query,
    "op10_language_id": language_query,
    "op11_topk_search": topk_query,
    "op12_periodic_runs": runs_query,
    "op13_structure_repair": repair_query,
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": line_dedup.LINES_SQL,
    "op3_quality_rules": quality_rules.QUALITY_SQL,
    "op7_decontamination": decontaminate.PASSAGES_SQL,
    "op8_chat_format": chat_format.CHAT_SQL,
    "op11_topk_search": topk_search.TOPK_SQL,
    "op12_periodic_runs": periodic_runs.RUNS_SQL,
    "op13_structure_repair": structure_repair.REPAIR_SQL,
}
