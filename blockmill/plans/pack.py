"""Pack a planned mix: one shuffle of the text, straight to the task that writes it.

The plan knows where every order bucket starts in the token stream, so each
document goes at once to the slab (a run of whole shards) its bucket falls in. A
bucket that crosses a slab boundary goes to both sides. Inside a slab a window
gives exact positions, and documents are cut and joined without another shuffle.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from blockmill.operators.blocks import whole_div
from blockmill.operators.mixing import ORDER, stream_offsets
from blockmill.plans.mix import MAX_SLABS, SLAB_TOKENS, MixPlan, placed_documents
from blockmill.session import default_parallelism, small_table


def _routes(
    plan: MixPlan, spark, first_block: int, last_block: int, slab_blocks: int
) -> DataFrame:
    """Bucket start and first and last slab of every bucket still to be packed."""
    seq_len = plan.settings.seq_len
    begin, end = plan.starts[:-1], plan.starts[1:]
    needed = (end > first_block * seq_len) & (begin < (last_block + 1) * seq_len)
    needed &= first_block <= last_block
    begin, end, bucket = begin[needed], end[needed], plan.buckets[needed]
    low = np.maximum(begin // seq_len, first_block) - first_block
    high = np.minimum((end - 1) // seq_len, last_block) - first_block
    return small_table(spark, {
        "bucket": pa.array(bucket, pa.int32()),
        "bucket_start": pa.array(begin, pa.int64()),
        "first_slab": pa.array(low // slab_blocks, pa.int32()),
        "last_slab": pa.array(high // slab_blocks, pa.int32()),
    })


def _slab_blocks(plan: MixPlan, spark, n_blocks: int, whole_shards: bool) -> int:
    tokens = n_blocks * plan.settings.seq_len
    slabs = min(MAX_SLABS, max(default_parallelism(spark), math.ceil(tokens / SLAB_TOKENS)))
    size = max(1, math.ceil(n_blocks / slabs))
    if whole_shards:
        per_shard = plan.settings.blocks_per_shard
        size = per_shard * math.ceil(size / per_shard)
    return size


def pack(
    docs: DataFrame,
    plan: MixPlan,
    tokenizer,
    first_block: int = 0,
    whole_shards: bool = False,
    with_tail: bool = False,
    end_block: int | None = None,
    placed: bool = False,
) -> DataFrame:
    """The blocks of the plan from ``first_block`` on, with ids, label and document count.

    With ``end_block`` only those before it: documents of later buckets are left
    out before the shuffle.

    ``docs`` are tokenised documents (``tokenizer.tokenize``), or with ``placed`` what
    ``stage_waves`` has made of them. With
    ``whole_shards`` no shard is divided between tasks, ready for the sink. With
    ``with_tail`` one more row, numbered after the last block, holds the tokens
    that were read but not packed: what is left of the last document when the
    budget ends the build, and less than one block when the documents end it.
    """
    spark = docs.sparkSession
    seq_len = plan.settings.seq_len
    end = plan.n_blocks if end_block is None else min(end_block, plan.n_blocks)
    if with_tail and end < plan.n_blocks:
        raise ValueError("only the end of a plan has a tail")
    last_block = end - (0 if with_tail else 1)
    n_blocks = max(0, last_block + 1 - first_block)
    slab_blocks = _slab_blocks(plan, spark, n_blocks, whole_shards)
    n_slabs = max(1, math.ceil(n_blocks / slab_blocks))

    if not placed:
        docs = placed_documents(docs, plan.lanes, plan.settings, plan.eos, plan.n_buckets)
    routed = (
        docs.join(_routes(plan, spark, first_block, last_block, slab_blocks), "bucket")
        .withColumn("slab", F.explode(F.sequence("first_slab", "last_slab")))
        .drop("first_slab", "last_slab")
        .repartitionById(n_slabs, F.col("slab"))
    )
    # The payload hash settles documents that agree in every key, for both slabs
    # that may see them.
    inside = Window.partitionBy("slab", "bucket").orderBy(*ORDER, F.xxhash64("payload"))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("bucket_start") + F.sum("len").over(upto) - F.col("len")

    slab_first = F.col("slab").cast("long") * slab_blocks + first_block
    slab_last = F.least(slab_first + slab_blocks - 1, F.lit(last_block).cast("long"))
    spans = (
        routed.withColumn("off", start)
        .withColumn("first", F.greatest(whole_div(F.col("off"), seq_len), slab_first))
        .withColumn(
            "last", F.least(whole_div(F.col("off") + F.col("len") - 1, seq_len), slab_last)
        )
        .filter(F.col("first") <= F.col("last"))
    )
    spans = _within_budget(spans, plan)

    def cut(block):
        begin = F.greatest(F.col("off"), block * seq_len) - F.col("off")
        upto = F.least(F.col("off") + F.col("len"), (block + 1) * seq_len) - F.col("off")
        if with_tail:
            upto = F.when(block == plan.n_blocks, F.col("len")).otherwise(upto)
        length = F.least(upto, F.col("n_tok")) - begin
        return begin.cast("int"), length.cast("int"), upto == F.col("len")

    pieces = tokenizer.pieces(F.col("payload"), F.sequence("first", "last"), cut)
    fragments = spans.select("slab", "off", "source", F.inline(pieces))
    ordered = F.sort_array(F.collect_list(F.struct("off", "piece")))
    return (
        fragments.groupBy("slab", "block_id")
        .agg(
            ordered.alias("parts"),
            F.max_by("source", "off").alias("source"),
            F.count("*").alias("n_docs"),
        )
        .select(
            "block_id",
            tokenizer.assemble(F.transform("parts", lambda p: p["piece"])).alias("input_ids"),
            "source",
            "n_docs",
        )
    )


def stage_waves(
    docs: DataFrame, plan: MixPlan, path: str, first_block: int, wave_blocks: int
) -> None:
    """Write all documents from ``first_block`` on into a folder for each wave of blocks.

    One pass over the text without a shuffle; a wave then reads its own folder. What
    comes before the first block or after the last one is left out, a bucket across two
    waves goes to both.
    """
    n_waves = max(1, math.ceil((plan.n_blocks - first_block) / wave_blocks))
    routes = _routes(plan, docs.sparkSession, first_block, plan.n_blocks, wave_blocks)
    placed = placed_documents(docs, plan.lanes, plan.settings, plan.eos, plan.n_buckets)
    last = F.least(F.col("last_slab"), F.lit(n_waves - 1))
    first = F.least(F.col("first_slab"), F.lit(n_waves - 1))
    (
        placed.join(routes, "bucket")
        .withColumn("wave", F.explode(F.sequence(first, last)))
        .drop("first_slab", "last_slab", "bucket_start")
        .write.mode("overwrite").partitionBy("wave").parquet(path)
    )


def packed_spans(docs: DataFrame, plan: MixPlan) -> DataFrame:
    """Position and length of every document that is read, without any text."""
    placed = placed_documents(docs, plan.lanes, plan.settings, plan.eos, plan.n_buckets)
    starts = small_table(docs.sparkSession, {
        "bucket": pa.array(plan.buckets, pa.int32()),
        "bucket_start": pa.array(plan.starts[:-1], pa.int64()),
    })
    spans = stream_offsets(
        placed.select("source", "epoch", "doc_id", "arrival", "bucket", "n_tok", "len"), starts
    )
    return _within_budget(spans, plan)


def _within_budget(spans: DataFrame, plan: MixPlan) -> DataFrame:
    """Nothing is read after the document that fills the budget."""
    if plan.settings.budget_blocks != plan.n_blocks:
        return spans
    return spans.filter(F.col("off") < plan.n_blocks * plan.settings.seq_len)
