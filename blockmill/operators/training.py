"""Packed rows as training rows and micro-batches, with their counters."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from blockmill.functions.ids import attention_mask, lm_labels, to_long_ids
from blockmill.operators.blocks import whole_div
from blockmill.operators.filters import exact_length, n_supervised
from blockmill.operators.prefix import running_start_by_group
from blockmill.session import broadcast_if_small, default_parallelism, stored

# Fixed sizes: rows that one task turns into batches, and shards in one part of
# a rank's running row count.
SLAB_ROWS = 1 << 16
MAX_SLABS = 1 << 15
_SHARDS_PER_PART = 4096


def training_rows(packed: DataFrame, pad_id: int | None) -> DataFrame:
    """Ids, labels and attention mask as 64-bit arrays; other columns are kept.

    ``pad_id=None`` supervises every token, end-of-text included.
    """
    ids = F.col("input_ids")
    return (
        packed.withColumn("labels", lm_labels(ids, pad_id))
        .withColumn("attention_mask", attention_mask(ids, pad_id))
        .withColumn("input_ids", to_long_ids(ids))
    )


def token_extrema(rows: DataFrame, *by: str) -> DataFrame:
    """Smallest and largest id, of the table or per group."""
    return rows.groupBy(*by).agg(
        F.min(F.array_min("input_ids")).alias("min_id"),
        F.max(F.array_max("input_ids")).alias("max_id"),
    )


def mask_stats(rows: DataFrame, *by: str) -> DataFrame:
    """Labels that count, unmasked positions and all positions of training rows."""
    ones = F.size(F.filter("attention_mask", lambda x: x == 1))
    return rows.groupBy(*by).agg(
        F.sum(n_supervised(F.col("labels"))).alias("valid_labels"),
        F.sum(ones).alias("mask_sum"),
        F.sum(F.size("attention_mask")).alias("elements"),
    )


def micro_batches(
    packed: DataFrame, assignment: DataFrame, size: int, seq_len: int, counts: DataFrame | None = None
) -> DataFrame:
    """Consecutive rows of every rank in batches of ``size``, the last one maybe short.

    Returns ``rank``, ``batch_id`` and the stacked ``input_ids``; labels and mask
    follow with ``batch_training_arrays``. ``counts`` (shard_id, n) may come from
    the manifest; it must count rows of the right length only.

    Row counts per shard place every shard in the row order of its rank, so rows
    go in one shuffle to the task that owns their run of batches. A shard across
    two runs goes to both.
    """
    spark = packed.sparkSession
    rows = exact_length(packed, seq_len).select("shard_id", "block_id", "input_ids")
    if counts is None:
        counts = rows.groupBy("shard_id").agg(F.count("*").alias("n"))
    # One row per shard; counting the rows reads all ids, so it is done once.
    counts = stored(assignment.join(counts, "shard_id"), "shard-rows")
    placed = running_start_by_group(
        counts, "rank", whole_div(F.col("shard_pos"), _SHARDS_PER_PART), ["shard_pos"],
        F.col("n"), "start",
    ).select("shard_id", "rank", "start", "n")
    total = placed.agg(
        F.count("*").alias("shards"), F.sum("n").alias("n"), F.max("rank").alias("rank"),
        F.max(F.col("start") + F.col("n")).alias("longest"),
    ).first()
    if not total["n"]:
        return rows.select(
            F.lit(0).alias("rank"), F.lit(0).cast("long").alias("batch_id"),
            F.array("input_ids").alias("input_ids"),
        ).limit(0)
    ranks = total["rank"] + 1
    slabs = max(default_parallelism(spark), math.ceil(total["n"] / SLAB_ROWS))
    slab_rows = size * max(1, math.ceil(total["n"] / min(slabs, MAX_SLABS) / size))
    per_rank = math.ceil(total["longest"] / slab_rows)

    first = whole_div(F.col("start"), slab_rows)
    last = whole_div(F.col("start") + F.col("n") - 1, slab_rows)
    routes = placed.withColumn("run", F.explode(F.sequence(first, last)))
    routed = (
        rows.join(broadcast_if_small(routes, total["shards"] + ranks * per_rank), "shard_id")
        .withColumn("slab", (F.col("rank") * per_rank + F.col("run")).cast("int"))
        .repartitionById(ranks * per_rank, F.col("slab"))
    )
    inside = Window.partitionBy("slab", "shard_id").orderBy("block_id")
    numbered = (
        routed.withColumn("pos", F.col("start") + F.row_number().over(inside) - 1)
        .filter(whole_div(F.col("pos"), slab_rows) == F.col("run"))
        .withColumn("batch_id", whole_div(F.col("pos"), size))
    )
    members = F.sort_array(F.collect_list(F.struct("pos", "input_ids")))
    return numbered.groupBy("slab", "rank", "batch_id").agg(
        F.transform(members, lambda m: m["input_ids"]).alias("input_ids")
    ).drop("slab")


def batch_training_arrays(batches: DataFrame, pad_id: int | None) -> DataFrame:
    """Labels and mask beside the stacked ids, all as 64-bit arrays."""
    ids = F.col("input_ids")
    return (
        batches.withColumn("labels", F.transform(ids, lambda row: lm_labels(row, pad_id)))
        .withColumn("attention_mask", F.transform(ids, lambda row: attention_mask(row, pad_id)))
        .withColumn("input_ids", ids.cast("array<array<bigint>>"))
    )
