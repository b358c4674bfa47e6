"""From raw documents to packed sequences: the operators of tallyframe.llm as stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontaminate, jaccard_join, language_id, packing, quality_rules
from tallyframe.llm.work import Workspace, small_batches


def _wrapped(docs: DataFrame, *columns: str) -> DataFrame:
    """The rows as one column, beside those that an operator needs, so that its columns can't replace theirs."""
    return docs.select(F.struct("*").alias("_document"), *columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the threshold table keeps."""
    return quality_rules.apply(_wrapped(docs, "text")).where("kept").select("_document.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read as one of the languages that the stage's own labels teach."""
    small_batches(spark)
    model = language_id.train(docs.select("doc_id", "text", "lang"))
    return docs if model is None else language_id.predict(_wrapped(docs, "text"), model).where("accepted").select("_document.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest key.

    Rows whose doc_id is null or repeated can't be told apart by it; a table with such rows is numbered first.
    """
    work = Workspace(spark, "near-duplicates")
    columns, key, number = docs.columns, "doc_id", "_near_duplicates_row"
    if not docs.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1").isEmpty():
        docs, key = work.save(docs.withColumn(number, F.monotonically_increasing_id()), "numbered"), number
    linked = jaccard_join.link(docs, work, key=key)
    others = linked.where("doc_id <> component_id").select(F.col("doc_id").alias(key))
    return docs.join(others, key, "left_anti").select(*columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    found = decontaminate.find(_wrapped(docs, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(~decontaminate.contaminated()).select("_document.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their token ids."""
    return packing.pack(docs, Workspace(spark, "packing"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("packing", packed),
]

#: Language models, joins and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each written as Parquet and read again."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = work.save(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
