"""Shard order and the split of shards over training ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from blockmill.functions.hashing import unit_hash
from blockmill.operators.blocks import whole_div
from blockmill.operators.prefix import running_start, unit_bucket

# Shard numbers are 32-bit, so this many in a bucket keep the bucket table small.
_SHARDS_PER_BUCKET = 4096
_SHUFFLE_BUCKETS = 4096


def sorted_shards(files: DataFrame) -> DataFrame:
    """Shards in the order of their numbers, with position ``pos`` from 0."""
    bucketed = files.select("shard_id", "file").withColumn(
        "bucket", whole_div(F.col("shard_id").cast("long"), _SHARDS_PER_BUCKET).cast("int")
    )
    return running_start(bucketed, "bucket", ["shard_id"], F.lit(1), "pos").drop("bucket")


def shuffled_shards(files: DataFrame, seed: int) -> DataFrame:
    """Shards in a seeded random order that is the same for every rank."""
    keyed = files.select("shard_id", "file").withColumn("u", unit_hash(seed, F.col("file")))
    keyed = keyed.withColumn("bucket", unit_bucket(F.col("u"), _SHUFFLE_BUCKETS))
    return running_start(keyed, "bucket", ["u", "file"], F.lit(1), "pos").drop("bucket", "u")


def rank_shards(files: DataFrame, world: int, seed: int | None = None) -> DataFrame:
    """Rank and place in the rank for every shard: strided over one shared order.

    All ranks see the same order, shuffled or not, so their shares are disjoint.
    """
    if world < 1:
        raise ValueError(f"world must be at least 1: {world}")
    ordered = sorted_shards(files) if seed is None else shuffled_shards(files, seed)
    return ordered.select(
        "shard_id", "file",
        F.pmod("pos", F.lit(world).cast("long")).cast("int").alias("rank"),
        whole_div(F.col("pos"), world).alias("shard_pos"),
    )


def rank_coverage(files: DataFrame, assignment: DataFrame) -> DataFrame:
    """Shards that no rank reads, or that several ranks read; empty when all is well."""
    read = assignment.groupBy("file").agg(F.count_distinct("rank").alias("ranks"))
    return (
        files.select("file").distinct().join(read, "file", "left")
        .fillna(0, ["ranks"])
        .filter(F.col("ranks") != 1)
    )


def step_plan(manifest: DataFrame, seq_len: int, batch: int, world: int, accum: int) -> DataFrame:
    """Tokens per optimizer step and the steps of one pass over the shards."""
    per_step = seq_len * batch * world * accum
    total = manifest.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("total_tokens")
    )
    return total.select(
        "total_tokens",
        F.lit(per_step).cast("long").alias("tokens_per_step"),
        F.ceil(F.col("total_tokens") / F.lit(per_step)).cast("long").alias("steps"),
    )
