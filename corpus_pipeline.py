"""The training-data pipeline: quality rules, near-dedup, substring dedup, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before
has kept; its result is written as Parquet and read again as the next one's ``docs``.
All stages but the last return the columns of ``documents``.

1. ``quality_rules``: documents that fail the base counts or the bands go.
2. ``simhash``: of every group of near copies the document with the smallest id stays.
3. ``substring_dedup``: passages of 50 words or more that an earlier document holds are
   cut out of ``text``; ``n_chars`` follows. Every document keeps its row, if
   need be with an empty text.
4. ``mixing``: documents are taken to the target weights, whole; a source that has to
   give more than it has is repeated.
5. ``bpe``: token ids of every document taken.

Nulls, empty texts, repeated rows and empty tables are met as the operators say; a row
without ``doc_id`` stays through the second stage.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from blockmill.llm import bpe, mixing, quality_rules as rules, simhash, substring_dedup
from blockmill.llm.queries import mix_plan
from blockmill.session import stored

# The whole size of what is left is the budget: large sources give way to small ones.
MIX_PERCENT = 100
# The encoder's tables beside a heap that the stages before have filled; they decide no token.
BPE_TABLES = {"chunks": 100_000, "pieces": 50_000, "states": 20_000}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep_good(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each_group(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, mix_plan(MIX_PERCENT))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    settings = replace(bpe.default_settings(), **BPE_TABLES)
    return bpe.encode_and_decode(docs, settings, ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("simhash", simhash_stage),
    ("substring_dedup", substring_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

# Vocabularies and components are beyond SQL; tests/llm holds run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the tables between them lie in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
