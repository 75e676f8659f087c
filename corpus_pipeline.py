"""From raw documents to packed sequences, in stages that are each written and read again.

Every stage takes the documents that its predecessor kept. All but the last return the columns of documents; n_chars
follows the text. What each does with nulls, empty texts and repeated rows is said in its operator.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import line_quality, line_templates, packing, simhash, suffix_dedup
from millrace.llm.common import written


def counted(docs: DataFrame) -> DataFrame:
    """Documents with n_chars as their text has it now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that fail."""
    return counted(line_quality.clean_documents(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose template recurs."""
    return counted(line_templates.clean_documents(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: the smallest id, ids before none, then by text."""
    return simhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without byte strings that start earlier."""
    return counted(suffix_dedup.clean_documents(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("best_fit_packing", best_fit_packing),
]

#: The stages after the first cannot be written in SQL; they are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
