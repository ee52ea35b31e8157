"""From raw documents to packed training sequences: five stages, each written before the next reads it.

    quality rules -> near-duplicates -> benchmark passages -> secrets -> packing

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``. Null texts fail the quality rules; repeated rows are near-duplicates; a table
without rows gives none.
"""

from pyspark.sql import DataFrame, SparkSession

from postsift.llm import decontaminate, line_quality, near_dup, packing, secret_scan
from postsift.llm.queries import table, tokenizer
from postsift.session import remove, scratch, shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines."""
    return line_quality.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return near_dup.keep_first(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("secrets", secrets),
    ("packed", packed),
]

# SQL has neither the hash nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written as Parquet and read again.

    What a stage wrote on its way is removed when its result is written, and that result when the
    next one is.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_dir(spark, f"stage-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
