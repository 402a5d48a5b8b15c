"""From document positions to fixed-length blocks and shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from blockmill.functions.ids import block_slice


def whole_div(value: Column, by: int) -> Column:
    """Whole division of longs, exact at any size."""
    return F.call_function("div", value, F.lit(int(by)).cast("long"))


def completed_blocks(off: Column, length: Column, seq_len: int, limit: int | None = None) -> Column:
    """Number of blocks a document completes, up to ``limit`` blocks in all."""
    upto, before = whole_div(off + length, seq_len), whole_div(off, seq_len)
    if limit is not None:
        top = F.lit(limit).cast("long")
        upto, before = F.least(upto, top), F.least(before, top)
    return upto - before


def block_overlap(docs: DataFrame, seq_len: int) -> DataFrame:
    """One row per block a document touches, from its position and length.

    The overlap join of document spans with block spans, as an explode: linear
    in its output and without a second table.
    """
    first = whole_div(F.col("off"), seq_len)
    last = whole_div(F.col("off") + F.col("len") - 1, seq_len)
    return docs.withColumn("block_id", F.explode(F.sequence(first, last)))


def document_fragments(docs: DataFrame, seq_len: int) -> DataFrame:
    """The ids of every document cut at the block ends; needs ``ids`` and ``off``."""
    cut = block_slice(F.col("ids"), F.col("off"), F.col("block_id"), seq_len)
    return block_overlap(docs, seq_len).withColumn("fragment", cut).drop("ids")


def assemble_blocks(fragments: DataFrame, seq_len: int) -> DataFrame:
    """Join fragments into blocks; only full ones are kept.

    A block has at most ``seq_len`` fragments, so no group can grow with the
    data. Its label is the source of the document that completed it.
    """
    parts = F.sort_array(F.collect_list(F.struct("off", "fragment")))
    return (
        fragments.groupBy("block_id")
        .agg(
            F.flatten(F.transform(parts, lambda p: p["fragment"])).alias("input_ids"),
            F.max_by("source", "off").alias("source"),
            F.count("*").alias("n_docs"),
        )
        .filter(F.size("input_ids") == seq_len)
    )


def assign_shards(blocks: DataFrame, blocks_per_shard: int) -> DataFrame:
    """Shard number of every block; block numbers have no gaps."""
    return blocks.withColumn(
        "shard_id", whole_div(F.col("block_id"), blocks_per_shard).cast("int")
    )


def budget_cut(blocks: DataFrame, total_tokens: int, seq_len: int) -> DataFrame:
    """Blocks within the token budget, which is rounded up to whole blocks."""
    return head_blocks(blocks, -(-total_tokens // seq_len))


def head_blocks(blocks: DataFrame, n: int) -> DataFrame:
    """The first ``n`` blocks of a mix."""
    return blocks.filter(F.col("block_id") < n)


def per_source_tokens(blocks: DataFrame, seq_len: int) -> DataFrame:
    """Tokens per source as the caps count them: whole blocks by label."""
    return blocks.groupBy("source").agg(
        (F.count("*") * F.lit(seq_len).cast("long")).alias("tokens")
    )


def mix_report(blocks: DataFrame, spans: DataFrame, specs: DataFrame, seq_len: int) -> DataFrame:
    """Asked-for and achieved share per source, and the use of its cap.

    ``spans`` has the source and packed token count of every document, which
    gives exact shares beside the block labels.
    """
    labelled = per_source_tokens(blocks, seq_len).withColumnRenamed("tokens", "label_tokens")
    exact = spans.groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum("len").cast("long").alias("doc_tokens")
    )
    wanted = specs.select(F.col("name").alias("source"), "weight", "token_cap")
    merged = (
        F.broadcast(wanted).join(exact, "source", "left").join(labelled, "source", "left")
        .fillna(0, ["n_docs", "doc_tokens", "label_tokens"])
    )
    # One row per source, so one task sums them.
    whole = Window.partitionBy()

    def share(column: str) -> Column:
        return F.try_divide(F.col(column), F.sum(column).over(whole))

    return merged.select(
        "source", "n_docs", "doc_tokens", "label_tokens", "token_cap",
        share("weight").alias("wanted_share"),
        share("n_docs").alias("doc_share"),
        share("doc_tokens").alias("token_share"),
        share("label_tokens").alias("label_share"),
        F.try_divide("label_tokens", "token_cap").alias("cap_use"),
    )
