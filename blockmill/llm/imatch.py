"""I-Match fingerprints: hashes of the telling terms of a text, under several lexicons.

Terms are words in lower case (A-Z) without punctuation at their ends. A term counts
if its inverse document frequency lies in a band: met in at least ``min_docs`` documents and
in a share of them from ``min_share`` to ``max_share``. The distinct terms that are left are
sorted (by their 64-bit hash) and hashed in that order under randomised lexicons, each of which
knows only a part of all terms. A lexicon's hash changes only if one of its own terms comes
or goes, so small edits leave most hashes as they are. Lexicons come in ``salts`` random
orders and several sizes: small ones suit long texts, large ones short texts. The smallest
know one term in 2^31, more than a string can hold, so no text is too long. Lexicons that
are expected to know more than ``largest`` terms of a text are left out for it: any change
of the text would break them, and no likeness reads them.

A fingerprint is the 32-bit hashes of the lexicons, size after size, behind the number of the
first size with a hash; a lexicon that knows no term of the text has zero. A text
with fewer than ``min_terms`` terms in the band uses all its terms. The likeness of two
fingerprints is 1 if they are equal, else the share of equal
hashes among the smallest lexicons of which enough know a term of either text.

Document frequencies are counted over all documents, by the 64-bit hash of a term. A task
counts about 2^``slot_bits`` distinct terms at a time and sends on what it has counted. The
sorted hashes of the terms in the band go to the tasks, 8 bytes each, and say exactly which
terms count; a term that no document has (cut in two by an edit) does not. Frequencies add
up to the documents times the mean number m of distinct terms in one, so at most
m / ``min_share`` terms are in the band, however many documents there are.

Null text: as empty; texts without terms have equal fingerprints. Null
``doc_id``: after all others. Rows that share an id, or have none, follow one another by the
hash of their text, and are dealt out by it where they fill several ranges; equal rows stay
together. Further columns are not read.
An empty table gives an empty table; the only document of a table is its own next.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from blockmill.llm.texts import SPACES, map_rows, rows_of

EDGES = b".,;:!?()[]{}\"'|-*#$%&<>/\\"
LAST = (1 << 63) - 1
_CHUNK = 1 << 18
# Bytes of text turned into Python objects at a time, and draws made at a time.
_MAX_BYTES, _MAX_DRAWS = 1 << 22, 1 << 20
_MAX_HASH = (1 << 32) - 1
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


@dataclass(frozen=True)
class IMatchSettings:
    min_docs: int = 2
    min_share: float = 2.0**-15
    max_share: float = 0.1
    slot_bits: int = 22
    salts: int = 32
    sizes: tuple[int, ...] = tuple(range(1, 32, 2))
    min_terms: int = 5
    largest: int = 8
    enough: float = 0.5
    seed: int = 1234


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """Kind of each byte (0: inside a term, 1: edge, 2: white space), and its random value, A as a."""
    kind = np.zeros(256, np.uint8)
    kind[list(EDGES)], kind[list(SPACES.encode())] = 1, 2
    value = np.random.default_rng(1).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    value[ord("A"): ord("Z") + 1] = value[ord("a"): ord("z") + 1]
    return kind, value


_KIND, _VALUE = _byte_tables()
_SPACE = re.compile(rb"[ \t-\r]")


class Terms:
    """Sorted distinct term hashes of texts, worked out over all bytes of many texts at once.

    A term's hash is the sum of its bytes' values times the powers of an odd number, modulo
    2^64, mixed. Texts are taken in pieces of about ``piece`` bytes, cut at white space.
    """

    def __init__(self, piece: int = 1 << 20):
        self._piece = piece
        self._powers = np.ones(1, np.uint64)

    def _powers_to(self, n: int) -> np.ndarray:
        if n > len(self._powers):
            factors = np.full(2 * n, _A, np.uint64)
            factors[0] = 1
            self._powers = np.multiply.accumulate(factors)
        return self._powers

    def _hash(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first byte of each term, in order."""
        data = np.frombuffer(raw, np.uint8)
        kind = _KIND[data]
        core = np.flatnonzero(kind == 0)
        if not len(core):
            return np.zeros(0, np.uint64), core
        word = np.cumsum(kind == 2, dtype=np.int32)[core]
        new = np.flatnonzero(word[1:] != word[:-1])
        first, last = core[np.append(0, new + 1)], core[np.append(new, len(core) - 1)]
        size = last + 1 - first
        begin = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(begin, size)
        value = _VALUE[data[np.repeat(first, size) + place]] * self._powers_to(int(size.max()))[place]
        found = np.add.reduceat(value, begin)
        found = (found ^ (found >> np.uint64(33))) * _B
        found = (found ^ (found >> np.uint64(33))) * _A
        return found ^ (found >> np.uint64(33)), first

    def __call__(self, raws: list[bytes]) -> list[np.ndarray]:
        joined, start, found = b"\n".join(raws), 0, []
        while start < len(joined) or not found:
            cut = _SPACE.search(joined, start + self._piece)
            end = cut.start() if cut else len(joined)
            values, first = self._hash(joined[start:end])
            found.append((values, first + start))
            start = end + 1
        values, first = map(np.concatenate, zip(*found))
        ends = np.cumsum([len(r) + 1 for r in raws])
        return [np.unique(v) for v in np.split(values, np.searchsorted(first, ends[:-1]))] if raws else []


class Printer:
    """Fingerprints of sorted term hashes, and their likeness."""

    def __init__(self, lexicon: np.ndarray, settings: IMatchSettings):
        self._lexicon, self._settings = lexicon, settings
        rng = np.random.default_rng(settings.seed)
        self._salts = rng.integers(0, 1 << 63, (settings.salts, 1), dtype=np.uint64)

    def _in_band(self, terms: np.ndarray) -> np.ndarray:
        if not len(self._lexicon):
            return terms[:0]
        at = np.minimum(np.searchsorted(self._lexicon, terms), len(self._lexicon) - 1)
        return terms[self._lexicon[at] == terms]

    def __call__(self, terms: np.ndarray) -> np.ndarray:
        """A hash for each lexicon, sizes by salts."""
        from xxhash import xxh32_intdigest

        s = self._settings
        band = self._in_band(terms)
        if len(band) < s.min_terms:
            band = terms
        out = np.zeros((len(s.sizes), s.salts), np.uint32)
        if not len(band):
            return out
        first = 0
        while first + 1 < len(s.sizes) and len(band) > s.largest << s.sizes[first]:
            first += 1
        # A lexicon of size k knows the terms whose draw begins with k zero bits, so
        # each is a part of the one before.
        salt, value, at = self._drawn(band, s.sizes[first])
        term = band[at]
        for k in range(first, len(s.sizes)):
            if k > first:
                inside = value < np.uint64(1 << (64 - s.sizes[k]))
                salt, value, term = salt[inside], value[inside], term[inside]
            if not len(salt):
                break
            raw, starts = term.tobytes(), np.append(0, np.flatnonzero(salt[1:] != salt[:-1]) + 1)
            ends = [*(8 * starts[1:]).tolist(), len(raw)]
            out[k, salt[starts]] = [
                1 + xxh32_intdigest(raw[a:b]) % _MAX_HASH for a, b in zip((8 * starts).tolist(), ends)
            ]
        return out

    def _drawn(self, band: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Salt, draw and term of what the lexicons of a size know, by salt, then as the terms stand."""
        step, found = max(1, _MAX_DRAWS // len(band)), []
        for start in range(0, len(self._salts), step):
            draw = (band[None, :] ^ self._salts[start: start + step]) * _A
            draw ^= draw >> np.uint64(32)
            draw *= _B
            salt, at = np.nonzero(draw < np.uint64(1 << (64 - size)))
            found.append((salt + start, draw[salt, at], at))
        return tuple(map(np.concatenate, zip(*found)))

    @staticmethod
    def text(found: np.ndarray) -> str:
        """The fingerprint as a string: number of the first size with a hash, then all hashes."""
        held = np.flatnonzero(found.any(axis=1))
        if not len(held):
            return "00"
        return f"{held[0]:02x}" + found[held[0]: held[-1] + 1].astype(">u4").tobytes().hex()

    def likeness(self, a: np.ndarray, b: np.ndarray) -> float:
        if np.array_equal(a, b):
            return 1.0
        told = (a > 0) | (b > 0)
        same = (a == b) & told
        counts = told.sum(axis=1)
        enough = np.flatnonzero(counts >= self._settings.enough * a.shape[1])
        level = int(enough[-1]) if len(enough) else 0
        return float(same[level].sum() / max(1, counts[level]))


def document_frequency_table(docs: DataFrame, settings: IMatchSettings) -> np.ndarray:
    """Sorted hashes of the terms whose document frequency lies in the band."""
    size = 1 << settings.slot_bits

    def count(batches):
        terms = Terms()
        values, sums, met, n_met = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

        def merged():
            found, n = np.unique(np.concatenate(met), return_counts=True) if met else (values[:0], sums[:0])
            both, place = np.unique(np.concatenate([values, found]), return_inverse=True)
            total = np.zeros(len(both), np.int64)
            np.add.at(total, place, np.concatenate([sums, n]))
            return both, total

        def sent():
            for start in range(0, len(values), _CHUNK):
                part = slice(start, start + _CHUNK)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[part].view(np.int64)), pa.array(sums[part])], names=["term", "n"]
                )

        for (texts,) in rows_of(batches, _MAX_BYTES):
            for t in terms([(x or "").encode("utf-8") for x in texts]):
                met.append(t)
                n_met += len(t)
            if n_met >= size:
                values, sums = merged()
                met, n_met = [], 0
                if len(values) >= size:
                    yield from sent()
                    values, sums = values[:0], sums[:0]
        values, sums = merged()
        yield from sent()

    n_docs = docs.count()
    most = max(settings.min_docs, int(settings.max_share * n_docs))
    least = max(settings.min_docs, math.ceil(settings.min_share * n_docs))
    counts = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    band = counts.filter(F.col("n").between(least, most)).select("term").toArrow()
    return np.sort(band["term"].to_numpy().view(np.uint64))


def in_order_with_next(docs: DataFrame, parts: int) -> DataFrame:
    """``doc, part, guest, text`` dealt out by ranges of ``doc``, sorted, each range followed
    by a guest: the first row of the next range that has rows (after the last: of the first).

    The text is shuffled once. The ranges come from approximate quantiles; which rows a
    range holds does not change what comes next to what.
    """
    ids = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "doc_id", "text", F.xxhash64("text").alias("h"))
    steps = [k / parts for k in range(1, parts)]
    found = ids.approxQuantile("doc", steps, max(0.2 / parts, 1e-4)) if parts > 1 else []
    # Doubles next to the ends of a long stand for the ends.
    marks = np.array([LAST if q >= float(LAST) else int(q) for q in found], np.int64)
    marks, fill = np.unique(marks, return_counts=True)
    before_mark = np.cumsum(fill) - fill

    @F.pandas_udf("int")
    def part_of(doc, h):
        """Ranges of ids; an id that fills several is cut by the hash of its texts."""
        doc, share = doc.to_numpy(), h.to_numpy() / 2.0**64 + 0.5
        if not len(marks):
            return pd.Series(np.zeros(len(doc), np.int32))
        at = np.searchsorted(marks, doc, side="right") - 1
        own = np.maximum(at, 0)
        inside = 1 + np.minimum(fill[own] - 1, (share * fill[own]).astype(np.int64))
        part = before_mark[own] + np.where(marks[own] == doc, inside, fill[own])
        return pd.Series(np.where(at < 0, 0, part).astype(np.int32))

    ranged = ids.withColumn("part", part_of("doc", "h"))
    # One row for each range.
    first = {p: (d, h) for p, (d, h) in ranged.groupBy("part").agg(F.min(F.struct("doc", "h"))).collect()}
    if not first:
        return ranged.withColumn("guest", F.lit(0)).select("doc", "doc_id", "part", "guest", "text")
    order = sorted(first)
    begins = np.zeros((2, order[-1] + 1), np.int64)
    before = np.zeros(order[-1] + 1, np.int32)
    begins[:, order] = np.array([first[p] for p in order], np.int64).T
    before[order] = [order[k - 1] for k in range(len(order))]

    @F.pandas_udf("int")
    def host_of(part, doc, h):
        part = part.to_numpy()
        leads = (begins[0, part] == doc.to_numpy()) & (begins[1, part] == h.to_numpy())
        return pd.Series(np.where(leads, before[part], -1).astype(np.int32))

    host = host_of("part", "doc", "h")
    home = F.struct(F.col("part"), F.lit(0).alias("guest"))
    places = F.when(host < 0, F.array(home)).otherwise(
        F.array(home, F.struct(host.alias("part"), F.lit(1).alias("guest")))
    )
    sent = ranged.withColumn("place", F.explode(places)).select(
        "doc", "doc_id", "h", "place.part", "place.guest", "text"
    )
    return sent.repartitionById(parts, F.col("part")).sortWithinPartitions("guest", "doc", "h")


OUT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
])


def edited(text: str, after: str) -> str:
    """The last quarter of a text replaced by as many code points of another."""
    n = len(text) // 4
    return text[: len(text) - n] + after[:n]


def fingerprints_with_next(docs: DataFrame, settings: IMatchSettings = IMatchSettings()) -> DataFrame:
    """Fingerprints of every row of ``doc_id, text``, of its edited text, and their likeness."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(document_frequency_table(docs, settings))
    arrow = to_arrow_schema(OUT)

    def run(batches):
        terms, printer = Terms(), Printer(table.value, settings)
        held, done = [], False  # the row before: doc_id, text, fingerprint
        for doc_ids, guests, texts in rows_of(batches, _MAX_BYTES):
            if done:  # only the first guest comes next
                continue
            if True in map(bool, guests):
                done, n = True, list(map(bool, guests)).index(True) + 1
                doc_ids, texts = doc_ids[:n], texts[:n]
            texts = [t or "" for t in texts]
            prints = map(printer, terms([t.encode("utf-8") for t in texts]))
            run_of = [*held, *zip(doc_ids, texts, prints)]
            held = run_of[-1:]
            raws = [edited(a[1], b[1]).encode("utf-8") for a, b in zip(run_of, run_of[1:])]
            out = []
            for (doc_id, text, own), (_, _, after), raw, found in zip(run_of, run_of[1:], raws, terms(raws)):
                other = printer(found)
                out.append((
                    doc_id, len(text), hashlib.sha256(raw).hexdigest(), printer.text(own), printer.text(other),
                    printer.likeness(own, other), printer.likeness(own, after),
                ))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = in_order_with_next(docs, max(1, parts))
    return ordered.select("doc_id", "guest", "text").mapInArrow(run, OUT)


def imatch_fingerprints(docs: DataFrame, settings: IMatchSettings = IMatchSettings()) -> DataFrame:
    """``doc_id, fingerprint`` of every row, without a shuffle of texts."""
    table = docs.sparkSession.sparkContext.broadcast(document_frequency_table(docs, settings))

    def make():
        terms, printer = Terms(), Printer(table.value, settings)

        def rows(doc_ids, texts):
            found = terms([(t or "").encode("utf-8") for t in texts])
            return [(d, printer.text(printer(f))) for d, f in zip(doc_ids, found)]

        return rows

    return map_rows(docs, ["doc_id", "text"], "doc_id long, fingerprint string", make, _MAX_BYTES)
