"""Substring dedup: windows of words that start in an earlier document, by super-k-mers.

A window is ``window`` consecutive words of one document. A word is removed if a
window that covers it has the same words as a window of a document with a smaller
``doc_id``. All windows are judged on the input.

1. Every window has a *minimiser*: the least hash of its runs of ``mini`` words.
   Consecutive windows with one minimiser form a super-k-mer, which travels as one
   packed string instead of as many overlapping windows.
2. A first pass counts documents by minimiser. Equal windows have equal minimisers,
   so a super-k-mer whose minimiser occurs in one document only cannot hold a
   repeated window and never travels. The minimisers met in two or more documents
   go to the tasks as a bit table of fixed size; a false hit only sends a string
   in vain.
3. Equal packed strings are folded into one with the smallest ``doc_id`` before
   they are shuffled, so copies of a passage cost one string however many there are.
4. In the bucket of a minimiser the windows of its distinct strings are sorted; equal
   ones get the smallest document. A minimiser with more than ``bucket`` distinct strings
   (a common phrase inside ever different text) is dealt out again by window.
5. A string's later documents lose all its windows, its first document those that an
   earlier string holds. The word ranges go back to the text by document.

Null text: as empty. Null ``doc_id``: later than all ids, and not earlier than
another null. Rows with one ``doc_id`` are one document: they take nothing from each
other. Texts with fewer words than a window lose nothing. Further columns are left
alone. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from blockmill.llm.texts import map_columns, map_rows, set_aside, tidy, words
from blockmill.session import stored

LAST = (1 << 63) - 1
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
KEY = ["doc", "body"]


@dataclass(frozen=True)
class RepeatSettings:
    """``filter_bits``: log2 of the bits in the table of shared minimisers (8 MB at 26)."""

    window: int = 50
    mini: int = 10
    longest: int = 256
    filter_bits: int = 26
    bucket: int = 4096

    def __post_init__(self):
        if not 1 <= self.mini <= self.window or self.longest < 1 or not 10 <= self.filter_bits <= 32:
            raise ValueError("1 <= mini <= window, longest >= 1, 10 <= filter_bits <= 32")


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value in each run of ``width``."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def super_kmers(hashes: np.ndarray, settings: RepeatSettings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and number of windows of each super-k-mer of a text.

    ``hashes`` are 64-bit hashes of the words. Runs longer than ``longest`` windows are cut.
    """
    n = len(hashes) - settings.window + 1
    if n < 1:
        none = np.zeros(0, np.int64)
        return none, none, none
    size = len(hashes) - settings.mini + 1
    grams = np.zeros(size, np.uint64)
    for k in range(settings.mini):
        grams = grams * _FACTOR + hashes[k: k + size]
    grams = (grams ^ (grams >> np.uint64(31))) * _MIX
    grams ^= grams >> np.uint64(29)
    least = _least(grams, settings.window - settings.mini + 1)
    new = np.ones(n, bool)
    new[1:] = least[1:] != least[:-1]
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, n))
    if length.max() > settings.longest:
        cuts = [np.arange(a, a + c, settings.longest) for a, c in zip(first.tolist(), length.tolist())]
        first = np.concatenate(cuts)
        length = np.diff(np.append(first, n))
    return least[first].view(np.int64), first, length


def _hashed(texts: list) -> tuple[list, list]:
    """Words of the texts and their 64-bit hashes."""
    import xxhash

    found = [words(t) for t in texts]
    known = {w: xxhash.xxh64_intdigest(w) for w in set(chain.from_iterable(found))}
    return found, [np.fromiter(map(known.__getitem__, f), np.uint64, len(f)) for f in found]


def _minimisers(docs: DataFrame, settings: RepeatSettings) -> DataFrame:
    def make():
        def columns(ids, texts):
            _, hashes = _hashed(texts)
            minis = [np.unique(super_kmers(h, settings)[0]) for h in hashes]
            return np.concatenate(minis), np.repeat(np.array(ids, np.int64), [len(m) for m in minis])

        return columns

    return map_columns(docs, ["doc", "text"], "mini long, doc long", make)


def _shared_table(docs: DataFrame, settings: RepeatSettings) -> np.ndarray:
    """One bit for each slot that holds a minimiser of two or more documents."""
    met = _minimisers(docs, settings).groupBy("mini").agg(F.min("doc").alias("a"), F.max("doc").alias("b"))
    slot = F.col("mini").bitwiseAND(F.lit((1 << settings.filter_bits) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    # At most 2^(filter_bits - 6) rows of two longs, whatever the corpus.
    cells = (
        met.filter("a < b").groupBy(F.shiftright(slot, 6).alias("cell"))
        .agg(F.bit_or(bit).alias("bits")).toArrow()
    )
    table = np.zeros(1 << (settings.filter_bits - 6), np.uint64)
    table[cells["cell"].to_numpy()] = cells["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return table


def _strings(docs: DataFrame, settings: RepeatSettings) -> DataFrame:
    """Every super-k-mer whose minimiser may be shared, with its place."""
    table = docs.sparkSession.sparkContext.broadcast(_shared_table(docs, settings))
    low, window = np.int64((1 << settings.filter_bits) - 1), settings.window

    def make():
        import xxhash

        shared = table.value

        def rows(ids, bodies, texts):
            found, hashes = _hashed(texts)
            for doc, body, text, h in zip(ids, bodies, found, hashes):
                minis, first, length = super_kmers(h, settings)
                slot = minis & low
                hit = (shared[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) > 0
                if not hit.any():
                    continue
                line = b" ".join(text)
                ends = np.cumsum(np.fromiter(map(len, text), np.int64, len(text)) + 1)
                begins = np.concatenate([[0], ends[:-1]])
                cut = ends[first + length + window - 2] - 1
                for k in np.flatnonzero(hit).tolist():
                    packed = line[begins[first[k]]: cut[k]]
                    yield (
                        int(minis[k]), xxhash.xxh3_128_digest(packed), packed,
                        doc, body, int(first[k]), int(length[k]),
                    )

        return rows

    schema = "mini long, sid binary, packed binary, doc long, body long, first int, n int"
    return map_rows(docs, ["doc", "body", "text"], schema, make)


def _rows_of_windows(packed: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the strings as rows of word numbers, and the string of each."""
    split = [p.split(b" ") for p in packed]
    known = {w: k for k, w in enumerate(dict.fromkeys(chain.from_iterable(split)))}
    rows = [
        np.lib.stride_tricks.sliding_window_view(
            np.fromiter(map(known.__getitem__, s), np.int32, len(s)), window
        ) for s in split
    ]
    return np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])


def first_documents(packed: list[bytes], docs: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the strings: its string, and the smallest document with that window."""
    rows, owner = _rows_of_windows(packed, window)
    whole = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * 4))).ravel()
    _, same = np.unique(whole, return_inverse=True)
    least = np.full(int(same.max()) + 1, LAST, np.int64)
    np.minimum.at(least, same, docs[owner])
    return owner, least[same]


def _runs(places: np.ndarray) -> list[dict]:
    """Consecutive places as first and number."""
    cut = np.flatnonzero(np.diff(places) != 1) + 1
    starts, ends = np.concatenate([[0], cut]), np.append(cut, len(places))
    return [{"first": int(places[a]), "n": int(b - a)} for a, b in zip(starts, ends)]


FOUND = "sid binary, held array<struct<first int, n int>>"


def _held_in_buckets(strings: DataFrame, window: int) -> DataFrame:
    """Windows of each string that a string with a smaller document holds, bucket by bucket.

    Strings arrive sorted by minimiser; one bucket is in memory at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql import types as T

    arrow = to_arrow_schema(T.StructType.fromDDL(FOUND))

    def bucket(sids, packed, docs):
        if len(sids) < 2:
            return
        docs = np.array(docs, np.int64)
        owner, least = first_documents(packed, docs, window)
        begin = np.searchsorted(owner, np.arange(len(sids)))
        lost = np.flatnonzero(least < docs[owner])
        for k in np.unique(owner[lost]).tolist():
            yield sids[k], _runs(lost[owner[lost] == k] - begin[k])

    def run(batches):
        mini, sids, packed, docs, out = None, [], [], [], []

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
            out.clear()
            return made

        for part in batches:
            for m, s, p, d in zip(*(c.to_pylist() for c in part.columns)):
                if m != mini:
                    out.extend(bucket(sids, packed, docs))
                    if len(out) > 1000:
                        yield batch()
                    mini, sids, packed, docs = m, [], [], []
                sids.append(s)
                packed.append(p)
                docs.append(d)
        out.extend(bucket(sids, packed, docs))
        if out:
            yield batch()

    dealt = strings.select("mini", "sid", "packed", "doc").repartition("mini").sortWithinPartitions("mini")
    return dealt.mapInArrow(tidy(run), FOUND)


def _held_by_window(strings: DataFrame, window: int) -> DataFrame:
    """The same for crowded minimisers: windows are dealt out one by one."""

    def make():
        import xxhash

        def rows(sids, packed, docs):
            for sid, line, doc in zip(sids, packed, docs):
                found = line.split(b" ")
                for k in range(len(found) - window + 1):
                    yield xxhash.xxh3_128_digest(b" ".join(found[k: k + window])), sid, k, doc

        return rows

    each = map_rows(strings, ["sid", "packed", "doc"], "key binary, sid binary, place int, doc long", make)
    least = each.groupBy("key").agg(F.min("doc").alias("least"))
    lost = each.join(least, "key").filter("least < doc")
    one = F.struct(F.col("place").alias("first"), F.lit(1).alias("n"))
    return lost.groupBy("sid").agg(F.collect_list(one).alias("held"))


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc, body, text``: a document's id and a hash of its text name its rows."""
    return docs.select(
        F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("body"), "text"
    )


def repeat_spans(docs: DataFrame, settings: RepeatSettings = RepeatSettings()) -> DataFrame:
    """``doc, body, spans``: the word ranges to remove, for documents that have some.

    A span is ``first`` (word number) and ``n`` (words); spans may overlap.
    """
    met = stored(_strings(_keyed(docs), settings), "super-kmers")
    strings = stored(
        met.groupBy("mini", "sid", "packed").agg(F.min("doc").alias("doc"), F.max("doc").alias("last")),
        "strings",
    )
    # A string alone under its minimiser has no other string to be compared with.
    counts = strings.groupBy("mini").agg(F.count(F.lit(1)).alias("strings")).filter("strings > 1")
    several = strings.join(counts, "mini")
    thin = several.filter(F.col("strings") <= settings.bucket)
    thick = several.filter(F.col("strings") > settings.bucket)
    held = _held_in_buckets(thin, settings.window).union(_held_by_window(thick, settings.window))
    known = strings.select("sid", F.col("doc").alias("origin"), "last").join(held, "sid", "left")
    known = known.filter("last > origin or held is not null")
    more = settings.window - 1
    whole = F.array(F.struct(F.col("first"), (F.col("n") + more).cast("int").alias("n")))
    part = F.transform("held", lambda x: F.struct(
        (F.col("first") + x["first"]).cast("int").alias("first"), (x["n"] + more).cast("int").alias("n")
    ))
    spans = F.when(F.col("doc") > F.col("origin"), whole).otherwise(part)
    return (
        met.select("sid", "doc", "body", "first", "n").join(known.drop("last"), "sid")
        .withColumn("spans", spans).filter("spans is not null")
        .groupBy(*KEY).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )


def with_spans(docs: DataFrame, settings: RepeatSettings = RepeatSettings(), out: str = "spans") -> DataFrame:
    """The rows of ``docs`` with all their columns and the spans to remove (null: none)."""
    found = repeat_spans(docs, settings).withColumnRenamed("spans", out)
    doc, body = F.coalesce("doc_id", F.lit(LAST)), F.xxhash64("text")
    keyed = docs.withColumns({"__doc": doc, "__body": body})
    found = found.withColumnsRenamed({"doc": "__doc", "body": "__body"})
    return keyed.join(found, ["__doc", "__body"], "left").select(*docs.columns, out)


def kept_words(found: list[bytes], spans: list | None) -> list[bytes]:
    """The words outside all spans."""
    if not spans:
        return found
    step = np.zeros(len(found) + 1, np.int64)
    np.add.at(step, [s["first"] for s in spans], 1)
    np.add.at(step, [s["first"] + s["n"] for s in spans], -1)
    gone = np.cumsum(step[:-1]) > 0
    return [w for w, g in zip(found, gone.tolist()) if not g]


DIGESTS = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def removal_digests(docs: DataFrame, settings: RepeatSettings = RepeatSettings()) -> DataFrame:
    """Words, removed words and a digest of what is left, for every row of ``doc_id, text``."""

    def make():
        def rows(ids, texts, spans):
            for doc_id, text, lost in zip(ids, texts, spans):
                found = words(text)
                kept = kept_words(found, lost)
                yield doc_id, len(found), len(found) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()

        return rows

    return map_rows(
        with_spans(docs.select("doc_id", "text"), settings), ["doc_id", "text", "spans"], DIGESTS, make
    )


def remove_repeats(docs: DataFrame, settings: RepeatSettings = RepeatSettings()) -> DataFrame:
    """The rows with repeated passages cut out of ``text``; other columns stay.

    A text that loses something is its kept words joined by one space.
    """

    def one(text, first, n):
        if first is None:
            return text
        spans = [{"first": a, "n": b} for a, b in zip(first, n)]
        return b" ".join(kept_words(words(text), spans)).decode("utf-8")

    def each(batches):
        for texts, starts, sizes in batches:
            yield pd.Series([one(*x) for x in zip(texts, starts, sizes)], dtype=object)

    cut = F.pandas_udf(tidy(each), "string", F.PandasUDFType.SCALAR_ITER)
    docs, back = set_aside(docs)
    marked = with_spans(docs, settings, "__spans")
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(
        cut("text", F.col("__spans.first"), F.col("__spans.n"))
    )
    return marked.withColumn("text", text).select(*docs.columns).withColumnsRenamed(back)
