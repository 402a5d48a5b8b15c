"""From a folder of shards to training rows and batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from blockmill.config import TokenProfile
from blockmill.operators.filters import exact_length, supervised_batches, token_range_guard
from blockmill.operators.ranks import rank_shards
from blockmill.operators.training import batch_training_arrays, micro_batches, training_rows
from blockmill.plans.batches import file_batches, runs_of
from blockmill.session import broadcast_if_small, exists
from blockmill.sources.manifest import scan_manifest
from blockmill.sources.published import published_manifest, scan_published
from blockmill.sources.shards import scan_packed, scan_shard_rows, shard_files


def _listed(spark: SparkSession, path: str, manifest: str | None) -> DataFrame:
    """Shards of a folder; with a manifest those that it lists."""
    files = shard_files(spark, path).select("shard_id", "file")
    if manifest is None:
        return files
    return files.join(scan_manifest(spark, manifest).select("file").distinct(), "file", "left_semi")


def _listed_rows(lines: DataFrame, seq_len: int) -> pd.DataFrame | None:
    """Rows of each shard by its newest line; None if the lines tell of another length."""
    lines = lines.groupBy("file").agg(
        F.max_by("rows", "time").alias("listed"), F.max_by("tokens", "time").alias("tokens")
    ).toPandas()
    fits = (lines["tokens"] == lines["listed"] * seq_len).all()
    return lines[["file", "listed"]] if fits else None


def _own_manifest(spark: SparkSession, path: str, manifest: str | bool | None) -> str | None:
    """The given manifest, or that of the build which the folder of shards is part of."""
    if manifest is False:
        return None
    if manifest is None and path.rstrip("/").endswith("/packed/part=shards"):
        beside = path.rstrip("/").removesuffix("/packed/part=shards") + "/manifest"
        return beside if exists(spark, beside) else None
    return manifest


def _published(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/commits")


def read_training_rows(
    spark: SparkSession, path: str, seq_len: int, profile: TokenProfile,
    world: int = 1, seed: int | None = None, manifest: str | bool | None = None, observation=None,
) -> DataFrame:
    """Training rows of all shards with the rank that reads them.

    In a folder of published shards those of its commits are read.
    ``manifest`` leaves out shards that it does not list; for the folder of a build
    its own one does, unless it is False. An ``observation`` gets the
    numbers of rows read and of rows skipped for their length.
    """
    if _published(spark, path):
        files, rows = published_manifest(spark, path).select("shard_id", "file"), scan_published(spark, path).drop("row")
    else:
        files, rows = _listed(spark, path, _own_manifest(spark, path, manifest)), scan_packed(spark, path)
    ranks = rank_shards(files, world, seed).select("shard_id", "rank", "shard_pos")
    rows = exact_length(rows.drop("file"), seq_len, observation)
    rows = token_range_guard(rows, profile.vocab_size)
    return training_rows(
        rows.join(broadcast_if_small(ranks, files.count()), "shard_id"), profile.pad_id
    )


def read_batches(
    spark: SparkSession, path: str, seq_len: int, profile: TokenProfile, size: int,
    world: int = 1, seed: int | None = None, manifest: str | bool | None = None, observation=None,
) -> DataFrame:
    """Micro-batches per rank, in order of ``batch_id``, without unsupervised ones.

    Batches are made where the files are read; see ``plans.batches``. By the manifest
    of a build all rows have the right length. Without one the ids are read once more
    to make sure; should there be rows of another length, they are skipped and all
    others shuffled to their batches. An ``observation`` gets the numbers of rows.
    """
    if _published(spark, path):
        lines = published_manifest(spark, path)
        names, rows = lines.select("shard_id", "file"), scan_published(spark, path)
    else:
        manifest = _own_manifest(spark, path, manifest)
        lines = None if manifest is None else scan_manifest(spark, manifest)
        names, rows = _listed(spark, path, manifest), scan_shard_rows(spark, path)
    # A few numbers for each shard, and for each run of rows that a task reads.
    files = spark.createDataFrame(names.toArrow())
    rows = rows.select("shard_id", "row", "block_id", "input_ids")
    assignment = rank_shards(files, world, seed).select("shard_id", "file", "rank", "shard_pos")
    listed = None if lines is None else _listed_rows(lines, seq_len)
    ranks, runs = assignment.toPandas(), runs_of(rows, seq_len if listed is None else None).toPandas()
    runs = runs[runs["shard_id"].isin(ranks["shard_id"])]
    odd = int(runs["odd"].sum() + runs["gaps"].sum())
    if listed is not None:
        held = runs.groupby("shard_id", as_index=False)["n"].sum().merge(ranks, on="shard_id").merge(listed, on="file")
        odd += int((held["n"] != held["listed"]).sum())
    if not odd:
        batches = file_batches(rows, runs, ranks, size, seq_len, profile.vocab_size, observation)
    else:
        kept = rows.join(broadcast_if_small(files, len(ranks)), "shard_id", "left_semi")
        kept = token_range_guard(exact_length(kept, seq_len, observation), profile.vocab_size)
        batches = micro_batches(kept, assignment, size, seq_len)
    # Decided by the ids, so that labels are made once and for kept batches only.
    kept = supervised_batches(batches, "input_ids", profile.pad_id)
    return batch_training_arrays(kept, profile.pad_id)
