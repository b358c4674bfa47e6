"""One query for each operator: the operator over its whole table, reduced to the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import backoff, decontaminate, html_text, jaccard_join, language_id, packing, quality_rules, sharding, token_counts, warc
from tallyframe.llm.work import Workspace


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))  # a null key has no remainder
    model = language_id.train(docs.where(~held_out).select("doc_id", "text", "lang"))
    out = language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches: all documents come in, documents without a language get one, toxic ones go."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    rollup = token_counts.TokenRollup(spark, Workspace(spark, "op2").path("rollup"))
    versions = sorted(token_counts.TOKENIZERS)
    toxic = _table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    gone = toxic.withColumns({"op": F.lit("delete"), "source": F.lit(None).cast("string"), "lang": F.lit(None).cast("string"), "n_tokens": F.lit(None).cast("long")})
    gone = gone.withColumn("tokenizer", F.explode(F.array(*map(F.lit, versions))))
    rollup.commit("load", token_counts.count(docs, *versions).withColumn("op", F.lit("insert")))
    named = docs.where("lang IS NULL").withColumn("lang", F.lit("und"))
    rollup.commit("name", token_counts.count(named, *versions).withColumn("op", F.lit("revise")))
    rollup.commit("toxic", gone)
    rollup.commit("toxic", gone)  # a second commit of a batch changes nothing
    return rollup.totals()


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(_table(spark, sf_dir, "documents"), Workspace(spark, "op3"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.apply(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op5")
    warc.write(_table(spark, sf_dir, "pages"), work.path("archive"))
    records = warc.read(spark, work.path("archive"), payload="false").where(F.col("record_type").isin("response", "revisit"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, Workspace(spark, "op6"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract(_table(spark, sf_dir, "pages"), Workspace(spark, "op7"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of logarithms are rounded, since they depend on the order of addition in their last digits."""
    out = backoff.score(_table(spark, sf_dir, "documents"), Workspace(spark, "op8"))
    return out.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.external_shuffle(docs, Workspace(spark, "op10"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_token_counts": op2_token_counts,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_quality_rules": op4_quality_rules,
        "op5_warc": op5_warc,
        "op6_packing": op6_packing,
        "op7_html_extraction": op7_html_extraction,
        "op8_lm_scoring": op8_lm_scoring,
        "op9_decontaminate": op9_decontaminate,
        "op10_sharding": op10_sharding,
    }
