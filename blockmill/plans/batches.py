"""Micro-batches made where the shard files are read.

Rows of a shard file come in order, so a task that reads a run of them can put
consecutive rows into batches itself. Row counts tell beforehand where every run begins
in the row order of its rank; a batch into which a run begins is shared by two tasks.
Only the rows of such batches are shuffled. With shards of whole batches there are none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from blockmill.operators.blocks import whole_div
from blockmill.operators.filters import exact_length, token_range_guard
from blockmill.session import broadcast_if_small

# Shared batches whose rows are named to the reader one by one.
MAX_NAMED = 200
_KEY = ["rank", "batch_id"]


def runs_of(rows: DataFrame, seq_len: int | None = None) -> DataFrame:
    """Runs of shard rows that one task reads: first row, number of rows, and of odd ones.

    Reads no column of the shards but, with ``seq_len``, the ids, to find rows of
    another length.
    """
    odd = F.lit(False) if seq_len is None else ~F.coalesce(F.size("input_ids") == seq_len, F.lit(False))
    return rows.groupBy("shard_id", F.spark_partition_id().alias("split")).agg(
        F.min("row").alias("first"), F.count("*").alias("n"), F.count_if(odd).alias("odd"),
        (F.max("row") - F.min("row") + 1 - F.count("*")).alias("gaps"),
    )


def place_shards(runs: pd.DataFrame, assignment: pd.DataFrame) -> pd.DataFrame:
    """Where every shard begins in the row order of its rank, and the rows of that rank."""
    counts = runs.groupby("shard_id", as_index=False)["n"].sum()
    placed = assignment.merge(counts, on="shard_id").sort_values(["rank", "shard_pos"])
    ranks = placed.groupby("rank")["n"]
    return placed.assign(start=ranks.cumsum() - placed["n"], rank_rows=ranks.transform("sum"))


def file_batches(
    rows: DataFrame, runs: pd.DataFrame, assignment: pd.DataFrame, size: int, seq_len: int, vocab_size: int,
    observation=None,
) -> DataFrame:
    """``rank``, ``batch_id`` and stacked ``input_ids`` of shard rows (shard_id, row, block_id, input_ids).

    ``runs`` must be those of the same rows, all without odd ones or gaps; they and the
    shards' ranks are a few numbers a shard. Should files come to be split otherwise when
    the batches are made, the job fails. An ``observation`` gets the number of rows.
    """
    spark = rows.sparkSession
    places = place_shards(runs, assignment)
    begun = runs.merge(places[["shard_id", "rank", "start"]], on="shard_id")
    begin = begun["start"] + begun["first"]
    shared = begun.assign(batch_id=begin // size)[begin % size != 0][_KEY].drop_duplicates()
    at = _table(spark, places, shard_id=pa.int32(), rank=pa.int32(), start=pa.int64(), rank_rows=pa.int64())
    some = _table(spark, shared, rank=pa.int32(), batch_id=pa.int64())
    placed = rows.join(at, "shard_id").withColumn("pos", F.col("start") + F.col("row"))
    placed = placed.withColumn("batch_id", whole_div(F.col("pos"), size))

    def columns(part: DataFrame, *more: str) -> DataFrame:
        return token_range_guard(part, vocab_size).select("rank", "batch_id", *more, "input_ids")

    seen = placed if observation is None else exact_length(placed, seq_len, observation)
    alone = seen if shared.empty else seen.join(some, _KEY, "left_anti")
    wanted = F.least(F.lit(size).cast("long"), F.col("rank_rows") - F.col("batch_id") * size)
    made = columns(alone.withColumn("wanted", wanted), "wanted").mapInArrow(
        _stacker(seq_len), "rank int, batch_id long, input_ids array<array<int>>"
    )
    if shared.empty:
        return made
    pieces = placed.join(some, _KEY, "left_semi")
    if len(shared) <= MAX_NAMED:
        pieces = placed.filter(_named(pieces)).join(some, _KEY, "left_semi")
    members = F.sort_array(F.collect_list(F.struct("pos", "input_ids")))
    joined = columns(pieces, "pos").groupBy("rank", "batch_id").agg(
        F.transform(members, lambda m: m["input_ids"]).alias("input_ids")
    )
    return made.unionByName(joined)


def _table(spark: SparkSession, rows: pd.DataFrame, **types: pa.DataType) -> DataFrame:
    table = pa.table({name: pa.array(rows[name].to_numpy(), kind) for name, kind in types.items()})
    return broadcast_if_small(spark.createDataFrame(table), len(rows))


def _named(pieces: DataFrame) -> Column:
    """The rows of few batches as ranges of block numbers, by which the reader skips pages."""
    found = pieces.groupBy("shard_id", *_KEY).agg(
        F.min("block_id").alias("low"), F.max("block_id").alias("high")
    ).collect()
    within = F.lit(False)
    for r in found:
        within = within | ((F.col("shard_id") == r["shard_id"]) & F.col("block_id").between(r["low"], r["high"]))
    return within


def _stacker(seq_len: int):
    """Consecutive rows of a batch into one row, without copying ids."""

    def stack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: pa.RecordBatch | None = None
        for batch in batches:
            if left is not None and left.num_rows:
                batch = pa.concat_batches([left, batch])
            ends = _group_ends(batch)
            # The last group may go on in the rows to come.
            done = int(ends[-2]) if len(ends) > 1 else 0
            left = batch.slice(done)
            if done:
                yield _stacked(batch.slice(0, done), ends[:-1], seq_len)
        if left is not None and left.num_rows:
            yield _stacked(left, np.array([left.num_rows]), seq_len)

    return stack


def _group_ends(batch: pa.RecordBatch) -> np.ndarray:
    """Row numbers at which a batch ends; the last one is the number of rows."""
    if not batch.num_rows:
        return np.zeros(0, np.int64)
    rank, number = (batch.column(k).to_numpy() for k in (0, 1))
    changes = np.flatnonzero((rank[1:] != rank[:-1]) | (number[1:] != number[:-1])) + 1
    return np.append(changes, batch.num_rows)


def _stacked(rows: pa.RecordBatch, ends: np.ndarray, seq_len: int) -> pa.RecordBatch:
    begins = np.concatenate([[0], ends[:-1]])
    ids = rows.column(3)
    if (rows.column(2).to_numpy()[begins] != ends - begins).any():
        raise ValueError("shard files were split otherwise than when their rows were counted")
    if ids.null_count or len(ids.flatten()) != len(ids) * seq_len or (np.diff(ids.offsets.to_numpy()) != seq_len).any():
        raise ValueError("a shard holds rows of another length than its manifest says; read it without the manifest")
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    return pa.RecordBatch.from_arrays(
        [rows.column(0).take(pa.array(begins)), rows.column(1).take(pa.array(begins)),
         pa.ListArray.from_arrays(offsets, ids)],
        names=["rank", "batch_id", "input_ids"],
    )
