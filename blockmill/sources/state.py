"""Resume state: an append-only log of one JSON line per finished build."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.errors import AnalysisException

from blockmill.config import STATE_SCHEMA, PackSettings, SourceSpec


def fingerprint(
    specs: Iterable[SourceSpec],
    settings: PackSettings,
    tokenizer_name: str,
    eos_id: int | None,
    inputs: Mapping[str, tuple[int, int]],
) -> str:
    """Digest of all that decides the order and content of the blocks.

    The token budget is left out: a larger one extends the same sequence. Record
    and token counts of the sources are in: they show most changes of the inputs,
    and the record count sets the pace of its source.
    """
    text = json.dumps({
        "specs": [asdict(s) for s in specs], "seq_len": settings.seq_len,
        "blocks_per_shard": settings.blocks_per_shard, "seed": settings.seed,
        "tokenizer": tokenizer_name, "eos": eos_id, "inputs": dict(inputs),
    }, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()


def save_state(state: DataFrame, path: str) -> None:
    """Append the state; the committer makes the new line visible at once."""
    state.select(*STATE_SCHEMA.fieldNames()).coalesce(1).write.mode("append").json(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest state as a table of one row, or of none for a fresh start."""
    try:
        log = spark.read.schema(STATE_SCHEMA).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STATE_SCHEMA)
    return log.orderBy(F.desc("version")).limit(1)


def save_identity(spark: SparkSession, path: str, print_id: str) -> None:
    """Remember what a build is made from before its first shard appears."""
    spark.createDataFrame([(print_id,)], "fingerprint string").coalesce(1).write.mode("overwrite").json(path)


def saved_identity(spark: SparkSession, path: str) -> str | None:
    try:
        row = spark.read.schema("fingerprint string").json(path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row and row[0]


def newest_state(spark: SparkSession, path: str) -> Row | None:
    rows = load_state(spark, path).collect()
    return rows[0] if rows else None
