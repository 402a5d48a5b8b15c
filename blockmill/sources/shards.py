"""Packed shards: one Parquet file per shard, written and read back."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from blockmill.functions.ids import shard_name
from blockmill.session import default_parallelism, few_listing_tasks, make_folder
from blockmill.sources.files import digests, file_sha256, file_system, full_address, reachable

# Encoding of the published shards.
_WRITER_OPTIONS = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "3",
    "parquet.enable.dictionary": "true",
    "parquet.page.size": str(1024 * 1024),
    # A shard is one file however many rows the session would allow in one.
    "maxRecordsPerFile": "0",
    # Overwriting replaces the shards that are written and no others.
    "partitionOverwriteMode": "dynamic",
}


def write_shards(
    blocks: DataFrame,
    path: str,
    blocks_per_shard: int,
    first_block: int = 0,
    first_shard: int = 0,
    mode: str = "errorifexists",
    clustered: bool = False,
    by: tuple[str, ...] = (),
) -> None:
    """Write blocks as ``shard_id=<n>/`` folders of one file each.

    ``clustered`` says that whole shards already share a task, as the packing
    leaves them; other tables are shuffled by shard once. Columns in ``by`` become
    folders above those of the shards. The output committer publishes the files
    when the job succeeds, so lost tasks leave nothing behind.
    """
    sharded = blocks.withColumn(
        "shard_id",
        (F.lit(first_shard) + F.expr(f"(block_id - {int(first_block)}L) div {int(blocks_per_shard)}L"))
        .cast("int"),
    )
    if not clustered:
        sharded = sharded.repartition("shard_id")
    (
        sharded.select("block_id", "input_ids", "source", *by, "shard_id")
        .sortWithinPartitions(*by, "shard_id", "block_id")
        .write.mode(mode).options(**_WRITER_OPTIONS).partitionBy(*by, "shard_id").parquet(path)
    )


_MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
# File names in folders of one shard each, and in flat folders.
_LAYOUTS = ("part-*.parquet", "shard-*.parquet")


def _shard_number(path: Column) -> Column:
    return F.regexp_extract(path, r"shard-(\d+)\.parquet", 1).try_cast("int")


def _first_layout(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """Name pattern and rows of the shards in a folder; other files in it are not opened."""
    for pattern in _LAYOUTS:
        try:
            with few_listing_tasks(spark):
                rows = spark.read.option("pathGlobFilter", pattern).parquet(path)
        except AnalysisException as error:
            if error.getCondition() not in _MISSING:
                raise
            continue
        if pattern == _LAYOUTS[1] or "shard_id" in rows.columns:
            return pattern, rows
    raise FileNotFoundError(f"no packed shards in {path}")


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with shard and block number, from the file where the rows have none."""
    if "shard_id" not in rows.columns:
        rows = rows.withColumn("shard_id", _shard_number(F.col("_metadata.file_path")))
    if "block_id" not in rows.columns:
        rows = rows.withColumn("block_id", F.col("_metadata.row_index"))
    return rows


def drop_shards(spark: SparkSession, path: str, first_shard: int) -> None:
    """Remove the folders of all shards from ``first_shard`` on."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(hadoop.Path(f"{path}/shard_id=*")) or ():
        if int(found.getPath().getName().split("=")[1]) >= first_shard:
            files.delete(found.getPath(), True)


def scan_packed(spark: SparkSession, path: str) -> DataFrame:
    """Packed rows with their shard number and shard name.

    Reads folders written by ``write_shards`` and flat folders of
    ``shard-*.parquet`` files, whose rows are numbered inside their file. Columns
    that are not used are not read.
    """
    _, rows = _first_layout(spark, path)
    return _numbered(rows).withColumn("file", shard_name(F.col("shard_id")))


def scan_shard_rows(spark: SparkSession, path: str) -> DataFrame:
    """Packed rows with the number ``row`` that each has in its shard file."""
    _, rows = _first_layout(spark, path)
    return _numbered(rows.withColumn("row", F.col("_metadata.row_index"))).select(
        "shard_id", "row", "block_id", "input_ids"
    )


# Columns that a shard file may have; the rest is taken from its path and its row numbers.
_STREAMED = "block_id long, input_ids array<int>, source string"


def stream_packed(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """Packed rows as a stream, a bounded number of shard files at a time.

    Takes the same folders as ``scan_packed``, which may still be empty or missing: each
    file's layout is told by its own path. A stream lists the folder anew when it runs:
    run it inside ``few_listing_tasks`` where shards are many.
    """
    make_folder(spark, path)
    with few_listing_tasks(spark):
        stream = (
            spark.readStream.schema(_STREAMED)
            # Folders are searched as they are, so none has to exist when the stream begins.
            .option("recursiveFileLookup", True).option("pathGlobFilter", "{part,shard}-*.parquet")
            .option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path)
        )
    place = F.col("_metadata.file_path")
    folder = F.regexp_extract(place, r"/shard_id=(\d+)/[^/]+$", 1).try_cast("int")
    return stream.select(
        F.coalesce("block_id", "_metadata.row_index").alias("block_id"), "input_ids", "source",
        F.coalesce(folder, _shard_number(place)).alias("shard_id"),
    ).filter(F.col("shard_id").isNotNull())


def scan_shard_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Every shard file with its name; ``content`` is read only where it is used.

    With folders per shard a filter on ``shard_id`` skips the other files.
    """
    with few_listing_tasks(spark):
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    if "shard_id" not in files.columns:
        files = files.withColumn("shard_id", _shard_number(F.col("path"))).filter(
            F.col("shard_id").isNotNull()
        )
    return files.select(
        "shard_id",
        shard_name(F.col("shard_id")).alias("file"),
        F.regexp_extract("path", r"(shard_id=[^/]+/)?[^/]+$", 0).alias("path"),
        F.col("modificationTime").alias("written_at"),
        "length",
        "content",
    )


def scan_shard_digests(
    spark: SparkSession, path: str, shards: tuple[int, int] | None = None
) -> DataFrame:
    """Number, write time, size and digest of every shard file, or of those from
    ``shards[0]`` up to ``shards[1]``; files of any size are read in pieces."""
    _, rows = _first_layout(spark, path)
    shard = F.col("shard_id") if "shard_id" in rows.columns else _shard_number(F.col("path"))
    wanted = shard.isNotNull()
    if shards is not None:
        wanted &= shard.between(shards[0], shards[1] - 1)
    return digests(spark, path, wanted=wanted).select(
        shard.alias("shard_id"), F.col("modificationTime").alias("written_at"), "length", "sha256"
    )


# Rows of a shard file of which the sources are held at a time.
_SOURCES_AT_ONCE = 1 << 16
_WRITTEN = pa.schema([
    ("shard_id", pa.int32()), ("rows", pa.int64()), ("sha256", pa.string()), ("time", pa.float64()),
    ("sources", pa.list_(pa.struct([("source", pa.string()), ("rows", pa.int64())]))),
])


def written_shards(spark: SparkSession, path: str, shards: tuple[int, int]) -> DataFrame:
    """Rows, digest, write time and rows by source of each shard file from ``shards[0]`` up to ``shards[1]``.

    For folders of one shard each, as ``write_shards`` leaves them. Their numbers tell where
    they are, so tasks open them without a listing of all shards. Where tasks cannot open the
    store, Spark's readers list and read it.
    """
    address = full_address(spark, path)
    if not reachable(address):
        rows = scan_packed(spark, path).filter(F.col("shard_id").between(shards[0], shards[1] - 1))
        by_source = rows.groupBy("shard_id", "source").agg(F.count("*").alias("rows"))
        counts = by_source.groupBy("shard_id").agg(
            F.sum("rows").alias("rows"), F.collect_list(F.struct("source", "rows")).alias("sources"))
        found = scan_shard_digests(spark, path, shards)
        time = (F.unix_millis("written_at") / 1000.0).alias("time")
        return counts.join(found, "shard_id").select("shard_id", "rows", "sha256", time, "sources")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(address)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                folder = pafs.FileSelector(f"{root}/shard_id={shard}", allow_not_found=True)
                found = [x for x in store.get_file_info(folder)
                         if x.base_name.startswith("part-") and x.base_name.endswith(".parquet")]
                if found:
                    yield pa.RecordBatch.from_pylist([_written(store, address, shard, x) for x in found], _WRITTEN)

    tasks = max(1, min(shards[1] - shards[0], 4 * default_parallelism(spark)))
    numbers = spark.range(shards[0], shards[1], 1, tasks)
    return numbers.mapInArrow(
        look, "shard_id int, rows long, sha256 string, time double, sources array<struct<source: string, rows: long>>")


def _written(store: pafs.FileSystem, address: str, shard: int, info: pafs.FileInfo) -> dict:
    counts: Counter = Counter()
    with store.open_input_file(info.path) as stream:
        table = pq.ParquetFile(stream)
        for part in table.iter_batches(_SOURCES_AT_ONCE, columns=["source"]):
            counts.update({x["values"]: x["counts"] for x in part.column(0).value_counts().to_pylist()})
        rows = table.metadata.num_rows
    digest = file_sha256(f"{address}/shard_id={shard}/{info.base_name}")
    return {
        "shard_id": shard, "rows": rows, "sha256": digest, "time": info.mtime_ns // 1_000_000 / 1000.0,
        "sources": [{"source": s, "rows": n} for s, n in counts.items()],
    }


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard file: number, name, path in the folder, write time and size."""
    return scan_shard_bytes(spark, path).drop("content")


def shard_summary(blocks: DataFrame, seq_len: int) -> DataFrame:
    """Rows and tokens per shard."""
    return (
        blocks.groupBy("shard_id").agg(F.count("*").alias("rows"))
        .withColumn("tokens", F.col("rows") * F.lit(seq_len).cast("long"))
        .withColumn("file", shard_name(F.col("shard_id")))
    )
