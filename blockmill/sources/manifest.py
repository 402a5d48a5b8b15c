"""The manifest: one JSON line per shard, written, read and checked."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from blockmill.config import MANIFEST_SCHEMA
from blockmill.functions.ids import shard_name
from blockmill.session import stored
from blockmill.sources.shards import scan_packed, scan_shard_digests, shard_summary


def _measured(
    spark: SparkSession, path: str, seq_len: int, shards: tuple[int, int] | None = None
) -> DataFrame:
    """Rows, tokens, digest and write time of the shards that lie in the folder."""
    rows = scan_packed(spark, path)
    if shards is not None:
        rows = rows.filter(F.col("shard_id").between(shards[0], shards[1] - 1))
    counts = shard_summary(rows, seq_len)
    digests = scan_shard_digests(spark, path, shards).select(
        "shard_id", "sha256", (F.unix_millis("written_at") / 1000.0).alias("time")
    )
    return counts.join(digests, "shard_id").select(
        "file", "rows", "tokens", "sha256", "time"
    )


def append_manifest(
    spark: SparkSession, path: str, manifest: str, seq_len: int,
    shards: tuple[int, int] | None = None,
) -> None:
    """Add a line for every shard, or for those from ``shards[0]`` up to ``shards[1]``.

    Shards that are listed with the same content get no second line, so a build
    that broke off after this step can be repeated.
    """
    append_lines(_measured(spark, path, seq_len, shards), manifest)


def lines_of(written: DataFrame, seq_len: int) -> DataFrame:
    """Manifest lines of the shards that ``written_shards`` has found."""
    tokens = F.col("rows") * F.lit(seq_len).cast("long")
    return written.select(shard_name(F.col("shard_id")).alias("file"), "rows", tokens.alias("tokens"), "sha256", "time")


def append_lines(lines: DataFrame, manifest: str) -> None:
    """Add those lines that do not stand in the manifest yet."""
    spark = lines.sparkSession
    try:
        listed = spark.read.schema(MANIFEST_SCHEMA).json(manifest).select("file", "sha256")
        lines = lines.join(listed, ["file", "sha256"], "left_anti")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    lines.write.mode("append").json(manifest)


def trim_manifest(spark: SparkSession, manifest: str, first_shard: int) -> None:
    """Take out the lines of all shards from ``first_shard`` on."""
    try:
        lines = spark.read.schema(MANIFEST_SCHEMA).json(manifest)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return
    number = F.regexp_extract("file", r"shard-(\d+)", 1).cast("int")
    if not lines.filter(number >= first_shard).isEmpty():
        kept = stored(lines.filter(number < first_shard), "manifest")
        kept.write.mode("overwrite").json(manifest)


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest lines, with the write time also as a timestamp."""
    lines = spark.read.schema(MANIFEST_SCHEMA).json(path)
    return lines.withColumn("written_at", F.timestamp_millis((F.col("time") * 1000).cast("long")))


def missing_shards(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Names that stand on one side only: no file for a line, or no line for a file."""
    listed = manifest.select("file").distinct()
    present = files.select("file").distinct()
    return (
        listed.join(present, "file", "left_anti").withColumn("problem", F.lit("no file"))
        .unionByName(
            present.join(listed, "file", "left_anti").withColumn("problem", F.lit("no line"))
        )
    )


def audit_manifest(spark: SparkSession, shards: str, manifest: str, seq_len: int) -> DataFrame:
    """One row per shard name with the verdict of a fresh count and digest."""
    lines = scan_manifest(spark, manifest).groupBy("file").agg(
        F.count("*").alias("lines"),
        F.max_by("rows", "time").alias("rows"),
        F.max_by("tokens", "time").alias("tokens"),
        F.max_by("sha256", "time").alias("sha256"),
    )
    found = _measured(spark, shards, seq_len).select(
        "file", F.col("rows").alias("found_rows"), F.col("tokens").alias("found_tokens"),
        F.col("sha256").alias("found_sha256"),
    )
    verdict = (
        F.when(F.col("found_rows").isNull(), "no file")
        .when(F.col("lines").isNull(), "no line")
        .when(F.col("lines") > 1, "listed twice")
        .when(F.col("sha256") != F.col("found_sha256"), "other content")
        .when((F.col("rows") != F.col("found_rows")) | (F.col("tokens") != F.col("found_tokens")),
              "other counts")
        .otherwise("ok")
    )
    return lines.join(found, "file", "full_outer").withColumn("verdict", verdict)
