"""Files read and written piece by piece inside tasks, through the store's own file system."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from blockmill.session import few_listing_tasks

PIECE = 1 << 20
# Address schemes that tasks can open themselves, and their names there.
SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs"}


def split_address(address: str) -> tuple[str, str, str]:
    """Scheme, host and path of an address; a bare path is a local one."""
    scheme, colon, rest = address.partition(":")
    if not colon or "/" in scheme:
        return "file", "", address
    if not rest.startswith("//"):
        return scheme, "", rest
    host, slash, path = rest[2:].partition("/")
    return scheme, host, slash + path


def reachable(address: str) -> bool:
    return split_address(address)[0] in SCHEMES


def file_system(address: str) -> tuple[pafs.FileSystem, str]:
    """The file system of an address and the path in it."""
    scheme, host, path = split_address(address)
    if scheme == "file":
        return pafs.LocalFileSystem(), path
    if scheme not in SCHEMES:
        raise ValueError(f"tasks cannot open {scheme}: addresses")
    files, root = pafs.FileSystem.from_uri(f"{SCHEMES[scheme]}://{host}/")
    return files, root.rstrip("/") + path


def file_sha256(address: str, piece: int = PIECE) -> str:
    """Digest of a file of any size; one piece of it is held at a time."""
    files, path = file_system(address)
    found = hashlib.sha256()
    with files.open_input_stream(path, buffer_size=0) as stream:
        while block := stream.read(piece):
            found.update(block)
    return found.hexdigest()


class HashingFile:
    """A file that is being written: passes bytes on and keeps their digest and number."""

    def __init__(self, address: str):
        files, path = file_system(address)
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self._out, self._hash, self._size = files.open_output_stream(path), hashlib.sha256(), 0
        self.closed = False

    def write(self, data) -> int:
        self._out.write(data)
        self._hash.update(data)
        self._size += len(data)
        return len(data)

    def tell(self) -> int:
        return self._size

    def flush(self) -> None:
        self._out.flush()

    def close(self) -> None:
        if not self.closed:
            self._out.close()
            self.closed = True

    def readable(self) -> bool:
        return False

    def seekable(self) -> bool:
        return False

    def writable(self) -> bool:
        return True

    @property
    def sha256(self) -> str:
        return self._hash.hexdigest()


def with_digests(files: DataFrame) -> DataFrame:
    """The files (a row each, address in ``path``) with the ``sha256`` of their bytes.

    Each task reads its files piece by piece, so their size has no bound; the table
    keeps its partitioning, which a listing has by bytes.
    """
    schema = T.StructType([*files.schema.fields, T.StructField("sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [file_sha256(p) for p in batch.column("path").to_pylist()]
            yield batch.append_column("sha256", pa.array(found, pa.string()))

    return files.mapInArrow(run, schema)


def digests(
    spark: SparkSession, path: str, pattern: str = "*.parquet", wanted: Column | None = None
) -> DataFrame:
    """The files of a folder (those ``wanted``) with their digests.

    They are read in pieces where tasks can open the store. Other stores go through
    Spark's reader of whole files, which takes up to 2 GB each.
    """
    with few_listing_tasks(spark):
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    if wanted is not None:
        files = files.filter(wanted)
    if reachable(full_address(spark, path)):
        return with_digests(files.drop("content"))
    return files.withColumn("sha256", F.sha2("content", 256)).drop("content")


def full_address(spark: SparkSession, path: str) -> str:
    """The address with its scheme, which may be the session's default."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(where).toString()
