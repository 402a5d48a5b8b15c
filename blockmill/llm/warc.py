"""WARC archives: a deterministic sharded writer, and a reader that checks what it reads.

*Ranges.* Page ids are cut into cells of equal width and the cells' payload bytes added up, in
smaller cells where a cell holds too much, so ranges of about ``range_bytes`` follow from exact
sums alone: the same pages give the same ranges on any cluster. One shuffle brings each range, sorted, to one task. Which page a
payload's other pages refer to is found on digests only; these notes travel with the pages as
small rows that sort just before them.

*Files.* A task writes its records one after another, each a gzip member of its own, and starts a
new file when the next record would take the compressed file over ``roll_bytes``. Headers and
digests are made anew from the payload; dates and record ids are functions of settings and
content. The same input gives the same files, byte by byte.

*Commit.* A file is written under a temporary name that no reader looks at and then renamed;
an attempt that is repeated renames the same bytes to the same name. The manifest is written
last, as one Spark job, and readers take only the files that it lists.

Of pages with equal payloads that with the largest ``page_id`` is written as response, the others as
revisits of it; payloads smaller than ``least_bytes`` are all responses. Null html: an empty
payload. Null urls: no target header. Pages without ``page_id`` are responses that none refers
to. Repeated rows give a record each. Further columns are not read. An empty table gives a
manifest without files, which reads as an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from blockmill.llm.texts import rows_of

CELLS = 1 << 14
_PIECE = 1 << 14
MANIFEST = "file string, records long, bytes long, sha256 string, first_page long, last_page long"
RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "url string, file string"
)
# Fixed value: the profile of a revisit by payload digest.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class WarcSettings:
    range_bytes: int = 64 << 20
    roll_bytes: int = 16 << 20
    least_bytes: int = 0
    date: str = "2000-01-01T00:00:00Z"
    level: int = 6

    def __post_init__(self):
        if self.range_bytes < 1 or self.roll_bytes < 1:
            raise ValueError("range_bytes and roll_bytes must be positive")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _line(value: str) -> str:
    """A header value without line breaks and other control characters."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One uncompressed record, with all headers and digests made from its content."""
    digest = base32_sha1(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode("ascii")
    block = http if refers_to is not None else http + payload
    headers = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}",
    ]
    if url is not None:
        headers.append(f"WARC-Target-URI: {_line(url)}")
    if refers_to is not None:
        headers += [
            f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Profile: {REVISIT_PROFILE}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    if page_id is not None:
        headers.append(f"X-Page-ID: {page_id}")
    headers += [
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return ("\r\n".join(headers) + "\r\n\r\n").encode("utf-8") + block + b"\r\n\r\n"


def _members(content: bytes):
    """The gzip members of a file, one at a time.

    A file is fed in small pieces: what is left over after a member is copied.
    """
    view, at = memoryview(content), 0
    while at < len(view):
        unpack, out = zlib.decompressobj(wbits=31), []
        while not unpack.eof:
            piece = view[at: at + _PIECE]
            if not len(piece):
                raise ValueError("archive ends inside a record")
            out.append(unpack.decompress(piece))
            at += len(piece)
        at -= len(unpack.unused_data)
        yield b"".join(out)


def read_record(data: bytes) -> tuple:
    """Page id, payload size, digest, type, page referred to and url of a record; digests are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    found = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
    block = rest[: int(found["content-length"])]
    if not version.startswith("WARC/") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(":")[1]) for x in http.decode("ascii").split("\r\n") if x.startswith("Content-Length:"))
    digest = found["warc-payload-digest"].removeprefix("sha1:")
    kind = found["warc-type"]
    if found["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError("block digest does not fit")
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError("payload digest does not fit")
    page, refers = found.get("x-page-id"), found.get("x-refers-to-page")
    return (
        None if page is None else int(page), size, digest, kind,
        None if refers is None else int(refers), found.get("warc-target-uri"),
    )


def _file_system(uri: str):
    """A file system that executors reach by its address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class _File:
    """An archive under a temporary name until it is whole."""

    def __init__(self, folder: str, name: str):
        self._fs, path = _file_system(folder)
        self.name, self._final = name, f"{path}/{name}"
        self._temporary = f"{path}/_{name}.{uuid.uuid4().hex}"
        self._out = self._fs.open_output_stream(self._temporary, compression=None)
        self._hash = hashlib.sha256()
        self.size, self.pages, self.records = 0, [], 0

    def add(self, member: bytes, page_id: int | None) -> None:
        self._out.write(member)
        self._hash.update(member)
        self.size += len(member)
        self.records += 1
        if page_id is not None:
            self.pages = [self.pages[0] if self.pages else page_id, page_id]

    def publish(self) -> tuple:
        self._out.close()
        self._fs.move(self._temporary, self._final)
        first, last = self.pages or (None, None)
        return self.name, self.records, self.size, self._hash.hexdigest(), first, last


def _cell_sums(sizes: DataFrame, starts: np.ndarray, ends: np.ndarray, widths: np.ndarray, per: int) -> dict[int, int]:
    """Bytes by cell: ``per`` cells of equal width in each of the intervals; others are left out."""

    def add(batches):
        for batch in batches:
            ids, size = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            at = np.searchsorted(starts, ids, side="right") - 1
            inside = (at >= 0) & (ids <= ends[at])
            ids, size, at = ids[inside], size[inside], at[inside]
            # Differences of any two ids fit the unsigned numbers.
            cell = (ids.view(np.uint64) - starts.view(np.uint64)[at]) // widths[at]
            keys, place = np.unique(at * per + cell.astype(np.int64), return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, place, size)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total)], names=["cell", "bytes"])

    made = sizes.mapInArrow(add, "cell long, bytes long").groupBy("cell").agg(F.sum("bytes").alias("bytes"))
    return dict(map(tuple, made.collect()))


def _bounds(pages: DataFrame, settings: WarcSettings) -> np.ndarray:
    """First page ids of all ranges but the first, from exact byte sums of cells of ids.

    A cell that holds more than a range may is cut into smaller ones, in as many rounds
    as it takes, so ids may lie close together in one place and far apart elsewhere.
    """
    low, high = pages.agg(F.min("page_id"), F.max("page_id")).first()
    if low is None:
        return np.zeros(0, np.int64)
    sizes = pages.filter("page_id is not null").select(
        "page_id", F.coalesce(F.octet_length("html"), F.lit(0)).cast("long").alias("bytes")
    )
    todo, settled = [(low, high)], []
    while todo:
        per = max(4, CELLS // len(todo))
        widths = [(b - a) // per + 1 for a, b in todo]
        found = _cell_sums(
            sizes, np.array([a for a, _ in todo], np.int64), np.array([b for _, b in todo], np.int64),
            np.array(widths, np.uint64), per,
        )
        again = []
        for key, size in sorted(found.items()):
            (a, b), width = todo[key // per], widths[key // per]
            start = a + key % per * width
            if size > settings.range_bytes and width > 1:
                again.append((start, min(b, start + width - 1)))
            else:
                settled.append((start, size))
        todo = again
    cuts, held = [], 0
    for start, size in sorted(settled):
        if held and held + size > settings.range_bytes:
            cuts.append(start)
            held = 0
        held += size
    return np.array(cuts, np.int64)


def write_archives(pages: DataFrame, folder: str, settings: WarcSettings = WarcSettings()) -> None:
    """Write ``page_id, url, html`` as ``folder/data/*.warc.gz`` and ``folder/manifest``."""
    data = f"{folder}/data"
    file_system, path = _file_system(data)
    file_system.create_dir(path, recursive=True)
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    digest = F.sha1(F.col("html").cast("binary"))
    known = pages.filter("page_id is not null").select(
        "page_id", digest.alias("digest"), F.octet_length("html").alias("size")
    ).filter(F.col("size") >= settings.least_bytes)
    keepers = known.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    notes = (
        known.join(keepers.filter("n > 1"), "digest").filter("page_id < refers_to")
        .select("page_id", "digest", "refers_to").distinct()
    )
    none = lambda kind: F.lit(None).cast(kind)
    rows = pages.select("page_id", digest.alias("digest"), none("long").alias("refers_to"), "url", "html").unionByName(
        notes.select("page_id", "digest", "refers_to", none("string").alias("url"), none("string").alias("html"))
    )
    bounds = _bounds(pages, settings)
    unnamed = pages.filter("page_id is null").agg(F.sum(F.octet_length("html").cast("long"))).first()[0]
    more = 0 if unnamed is None else 1 + unnamed // settings.range_bytes

    @F.pandas_udf("int")
    def range_of(page_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, page_id.to_numpy(), side="right").astype(np.int32))

    # Pages without an id have ranges of their own behind the others, by digest.
    part = F.when(F.col("page_id").isNotNull(), range_of(F.coalesce("page_id", F.lit(0))))
    part = F.coalesce(part, (F.pmod(F.xxhash64("digest"), F.lit(max(1, more))) + len(bounds) + 1).cast("int"))
    ordered = (
        rows.withColumn("part", part).repartitionById(len(bounds) + 1 + more, F.col("part"))
        .sortWithinPartitions(F.col("page_id").asc_nulls_last(), "digest", F.col("html").isNotNull())
        .select("part", "page_id", "digest", "refers_to", "url", "html")
    )
    arrow = to_arrow_schema(T.StructType.fromDDL(MANIFEST))

    def write(batches):
        out, note, done, number = None, None, [], 0
        for values in rows_of(batches):
            for part, page_id, own, refers_to, url, text in zip(*values):
                if text is None:
                    note = (page_id, own, refers_to)
                    continue
                target = note[2] if note and page_id is not None and note[:2] == (page_id, own) else None
                record = make_record(page_id, url, text.encode("utf-8"), target, settings.date)
                pack = zlib.compressobj(settings.level, wbits=31)
                member = pack.compress(record) + pack.flush()
                if out is not None and out.size + len(member) > settings.roll_bytes:
                    done.append(out.publish())
                    out = None
                if out is None:
                    out, number = _File(data, f"pages-{part:06d}-{number:05d}.warc.gz"), number + 1
                out.add(member, page_id)
        if out is not None:
            done.append(out.publish())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)

    ordered.mapInArrow(write, MANIFEST).write.json(f"{folder}/manifest")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{folder}/manifest")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each record of the files that the manifest lists; their content is checked."""
    listed = read_manifest(spark, folder).select("file", "sha256")
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(f"{folder}/data")
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").join(listed, "file")
    )
    arrow = to_arrow_schema(T.StructType.fromDDL(RECORDS))

    def read(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                name, content, digest = (batch.column(i)[k].as_py() for i in range(3))
                if hashlib.sha256(content).hexdigest() != digest:
                    raise ValueError(f"{name} is not the file that the manifest lists")
                found = [(*read_record(m), name) for m in _members(content)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    return files.select("file", "content", "sha256").mapInArrow(read, RECORDS)
