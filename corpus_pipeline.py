"""Corpus pipeline over `documents`: reject toxic texts, keep one near-duplicate of each group, redact
secrets, mix sources to target weights, and encode.

Stage 1 drops the documents that the toxicity operator scores 0.5 or more (it learns from the labels
that are not held out). Stage 2 keeps, of each class of near-duplicates, the row with the smallest
doc_id; texts without words all stay. Stage 3 replaces every reported secret by a mark and sets n_chars
anew. Stage 4 draws whole documents to meet the sources' targets: a document may come up to twice or
not at all. Stage 5 encodes and decodes every draw. Null columns, repeated rows, extra columns and empty
tables behave as the operators' docstrings say. What a stage needs for itself goes when it is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import bpe, mixing, near_dedup, secrets, toxicity
from framewright.llm.common import drop_table, parts, tidy, write_table
from framewright.llm.queries import tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else clean


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    drawn = mixing.mix(docs).repartitionByRange(parts(spark), "__shard", "__order").sortWithinPartitions("__shard", "__order")
    return drawn.select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_filter),
    ("near-duplicates", near_duplicates),
    ("secrets", secret_redaction),
    ("mixing", source_mixing),
    ("encoding", encoding),
]
#: Signatures, neighbours and tokenizers are beyond SQL; a test holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with tidy(spark):
            found = stage(spark, docs, sf_dir)
            path = write_table(found, f"pipeline-{name}")
        docs = spark.read.schema(found.schema).parquet(path)
        if last:
            drop_table(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
