"""Shards that commit files alone make visible: no rename, many shards in a folder.

A task writes its shards straight to their final place, under names no other attempt
uses, hashes the bytes as they go out, and lists them in a small file of its own. The
driver gets the name of one list from each task that has succeeded and writes them into
a commit file, which is created whole and never replaced. Readers follow commits to lists
and lists to shards, so what lost tasks or broken attempts have left is never opened.

    path/shards/group=<n>/shard-<number>-<attempt>.parquet
    path/lists/<attempt>.json         a manifest line for each shard, with its path
    path/commits/<version>.json       the lists that count

A shard published again replaces the older one. A commit file that is not whole (a driver lost
while writing) counts for nothing. The driver holds one list name a task and, to read,
one path a shard, as Spark's own file index does.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from blockmill.config import MANIFEST_SCHEMA
from blockmill.functions.ids import shard_name
from blockmill.session import broadcast_if_small, create_file, folder_names
from blockmill.sources.files import HashingFile, file_system, full_address, reachable, with_digests

SHARDS_IN_FOLDER = 1000
LISTED = T.StructType([
    *MANIFEST_SCHEMA.fields, T.StructField("shard_id", T.IntegerType()), T.StructField("path", T.StringType()),
])
_ROWS = pa.schema([("block_id", pa.int64()), ("input_ids", pa.list_(pa.int32())), ("source", pa.string())])


class _ShardWriter:
    """One shard file, written batch by batch."""

    def __init__(self, root: str, shard: int, attempt: str, in_folder: int):
        self.shard, self._rows, self._tokens = shard, 0, 0
        self._path = f"shards/group={shard // in_folder}/shard-{shard:06d}-{attempt}.parquet"
        self._file = HashingFile(f"{root}/{self._path}")
        self._writer = pq.ParquetWriter(
            self._file, _ROWS, compression="zstd", compression_level=3, data_page_size=1 << 20
        )

    def add(self, rows: pa.RecordBatch) -> None:
        table = pa.Table.from_batches([rows]).select(_ROWS.names).cast(_ROWS)
        self._writer.write_table(table)
        self._rows += table.num_rows
        self._tokens += sum(len(c.flatten()) for c in table["input_ids"].chunks)

    def close(self) -> dict:
        self._writer.close()
        self._file.close()
        return {
            "file": f"shard-{self.shard:06d}.parquet", "rows": self._rows, "tokens": self._tokens,
            "sha256": self._file.sha256, "time": time.time(), "shard_id": self.shard, "path": self._path,
        }


def write_attempt(
    blocks: DataFrame, path: str, blocks_per_shard: int, first_block: int = 0, first_shard: int = 0,
    in_folder: int = SHARDS_IN_FOLDER, clustered: bool = False,
) -> list[str]:
    """Write shards that nobody sees yet; the names of their lists, one a task.

    ``clustered`` says that whole shards already share a task, as the packing leaves them.
    """
    root = full_address(blocks.sparkSession, path)
    if not reachable(root):
        raise ValueError(f"tasks cannot write to {path}")
    shard = F.lit(first_shard) + F.expr(f"(block_id - {int(first_block)}L) div {int(blocks_per_shard)}L")
    sharded = blocks.select(shard.cast("int").alias("shard_id"), "block_id", "input_ids", "source")
    if not clustered:
        sharded = sharded.repartition("shard_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, lines, shard = uuid.uuid4().hex, [], None
        for batch in batches:
            ids = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if shard is None or shard.shard != ids[start]:
                    if shard is not None:
                        lines.append(shard.close())
                    shard = _ShardWriter(root, int(ids[start]), attempt, in_folder)
                shard.add(batch.slice(start, end - start))
        if shard is None:
            return
        lines.append(shard.close())
        files, target = file_system(f"{root}/lists/{attempt}.json")
        files.create_dir(target.rsplit("/", 1)[0], recursive=True)
        with files.open_output_stream(target) as out:
            out.write("".join(json.dumps(line) + "\n" for line in lines).encode())
        yield pa.RecordBatch.from_pydict({"list": [attempt]})

    lists = sharded.sortWithinPartitions("shard_id", "block_id").mapInArrow(run, "list string")
    return sorted(r["list"] for r in lists.collect())


def commit(spark: SparkSession, path: str, lists: list[str]) -> int:
    """Make the shards of these lists visible, all at once; the version that this makes.

    Two writers that commit at a time cannot both get a version: the later one fails.
    """
    taken = [int(n.split(".")[0]) for n in folder_names(spark, f"{path}/commits") if n.endswith(".json")]
    version = max(taken, default=-1) + 1
    body = json.dumps({"version": version, "lists": lists, "whole": True})
    create_file(spark, f"{path}/commits/{version:09d}.json", body.encode())
    return version


def publish_shards(blocks: DataFrame, path: str, blocks_per_shard: int, **more) -> int:
    """Write blocks as shards and commit them; see ``write_attempt`` for further settings."""
    return commit(blocks.sparkSession, path, write_attempt(blocks, path, blocks_per_shard, **more))


def committed_lists(spark: SparkSession, path: str) -> dict[str, int]:
    """Version of each list that a whole commit names."""
    if not folder_names(spark, f"{path}/commits"):
        return {}
    found = {}
    for row in spark.read.text(f"{path}/commits", wholetext=True).collect():
        try:
            told = json.loads(row["value"])
        except ValueError:
            continue
        if isinstance(told, dict) and told.get("whole"):
            found.update(dict.fromkeys(told["lists"], told["version"]))
    return found


def published_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The newest line of every published shard: its manifest line, number and path."""
    lists = committed_lists(spark, path)
    if not lists:
        return spark.createDataFrame([], LISTED)
    lines = spark.read.schema(LISTED).json([f"{path}/lists/{name}.json" for name in sorted(lists)])
    versions = spark.createDataFrame([(f"{n}.json", v) for n, v in lists.items()], "list string, version long")
    told = lines.withColumn("list", F.col("_metadata.file_name")).join(
        broadcast_if_small(versions, len(lists)), "list"
    )
    newest = told.groupBy("shard_id").agg(F.max_by(F.struct(*LISTED.names), "version").alias("line"))
    return newest.select("line.*")


def scan_published(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the published shards, with shard number and name and the ``row`` in the shard."""
    paths = [r["path"] for r in published_manifest(spark, path).select("path").collect()]
    if not paths:
        raise FileNotFoundError(f"no published shards in {path}")
    shard = F.regexp_extract(F.col("_metadata.file_name"), r"shard-(\d+)-", 1).cast("int")
    rows = spark.read.parquet(*[f"{path}/{p}" for p in sorted(paths)]).select(
        "*", shard.alias("shard_id"), F.col("_metadata.row_index").alias("row")
    )
    return rows.withColumn("file", shard_name(F.col("shard_id")))


def _present(spark: SparkSession, path: str) -> DataFrame:
    """All shard files in the folders, published or not: full and relative path."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "shard-*.parquet").load(f"{path}/shards")
    )
    return files.select("path", F.regexp_extract("path", r"shards/group=\d+/[^/]+$", 0).alias("place"))


def audit_published(spark: SparkSession, path: str) -> DataFrame:
    """One row per published shard with the verdict of a fresh digest, read in pieces."""
    lines = published_manifest(spark, path).withColumnRenamed("path", "place")
    found = with_digests(_present(spark, path).join(lines.select("place"), "place", "left_semi"))
    found = found.select("place", F.col("sha256").alias("found_sha256"))
    verdict = (
        F.when(F.col("found_sha256").isNull(), "no file")
        .when(F.col("sha256") != F.col("found_sha256"), "other content").otherwise("ok")
    )
    return lines.join(found, "place", "left").withColumn("verdict", verdict)


def sweep(spark: SparkSession, path: str) -> int:
    """Delete shard files that no commit names; how many. Not beside a running writer."""
    lines = published_manifest(spark, path).withColumnRenamed("path", "place")
    strays = _present(spark, path).join(lines.select("place"), "place", "left_anti").select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            for address in batch.column(0).to_pylist():
                files, target = file_system(address)
                files.delete_file(target)
                n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return strays.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
