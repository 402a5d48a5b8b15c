"""Fill-in-the-middle: documents cut at token boundaries and put together in another order.

A token is white space with the word after it, or white space at the end of a text.
The cuts of a text are two ranks (numbers of tokens) from a seeded hash of its id.
Where a rank lies comes from a learned index over the text's boundaries:

* Segments of a line are fitted to (rank, offset), each as long as some slope keeps
  every boundary within ``ERROR`` bytes (a shrinking cone of slopes).
* A rank's offset is predicted by its segment's line; the residual that is stored for
  the rank, one signed byte, corrects the prediction to the exact offset.

An index so takes one byte a token and 24 bytes a segment. ``rank_indexes`` returns it
as a table, from which texts can be cut again under another seed without being split
again.

Null text: as empty. Empty text: form ``plain``, no tokens. A text that holds one of
the sentinels stays ``plain``, so that every output can be taken apart again. A null
``doc_id`` is hashed as the empty string; repeated rows give repeated results; further
columns of the input are not read. An empty table gives an empty table.

One pass without a shuffle, row by row: skew of sources or copies plays no part. Memory
per task: a slice of rows of bounded size, or one longer text.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from blockmill.llm.texts import map_rows, utf8

# Bytes that a line may miss a boundary by; residuals then fit a signed byte.
ERROR = 120
# The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class FimSettings:
    """Shares in percent: of texts that are cut, and among those of suffix-first ones."""

    seed: int = 42
    cut_percent: int = 50
    suffix_first_percent: int = 80


def boundaries(raw: bytes) -> np.ndarray:
    """Byte offsets at which tokens begin and end, from 0 to the length of the text."""
    data = np.frombuffer(raw, np.uint8)
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    inner = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    return np.concatenate([[0], inner, [len(raw)]] if len(raw) else [[0]]).astype(np.int64)


class RankIndex:
    """Offsets by rank: lines of bounded error, and what they miss."""

    def __init__(self, firsts: np.ndarray, bases: np.ndarray, slopes: np.ndarray, residuals: np.ndarray):
        self.firsts, self.bases, self.slopes, self.residuals = firsts, bases, slopes, residuals

    @classmethod
    def fit(cls, offsets: np.ndarray, error: int = ERROR) -> RankIndex:
        firsts, slopes = [], []
        first, n = 0, len(offsets)
        while first < n:
            after, slope = _longest_line(offsets, first, error)
            firsts.append(first)
            slopes.append(slope)
            first = after
        found = cls(
            np.array(firsts, np.int64), offsets[firsts], np.array(slopes), np.zeros(n, np.int8)
        )
        missed = offsets - found.predict(np.arange(n))
        if n and np.abs(missed).max() > 127:
            raise ValueError(f"an error of {error} bytes needs wider residuals")
        found.residuals = missed.astype(np.int8)
        return found

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.firsts, ranks, side="right") - 1
        return self.bases[at] + np.rint(self.slopes[at] * (ranks - self.firsts[at])).astype(np.int64)

    def offsets(self, ranks) -> np.ndarray:
        """The exact offsets of boundaries: predicted, then corrected."""
        ranks = np.asarray(ranks, np.int64)
        return self.predict(ranks) + self.residuals[ranks]


def _longest_line(offsets: np.ndarray, first: int, error: int) -> tuple[int, float]:
    """How far one line from boundary ``first`` serves, and its slope."""
    low, high = -np.inf, np.inf
    at, width, n = first + 1, 256, len(offsets)
    while at < n:
        run = np.arange(at - first, min(n, at + width) - first)
        rise = offsets[at: at + width] - offsets[first]
        highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
        lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
        closed = lows > highs
        stop = int(closed.argmax()) if closed.any() else len(run)
        if stop:
            low, high = lows[stop - 1], highs[stop - 1]
        at += stop
        if stop < len(run):
            break
        width *= 2
    return at, float((low + high) / 2) if at > first + 1 else 0.0


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    hexed = hashlib.sha256(text.encode()).hexdigest()
    return tuple(int(hexed[k: k + 8], 16) for k in range(0, 32, 8))


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _code_points(raw: bytes) -> int:
    data = np.frombuffer(raw, np.uint8)
    return int(((data & 0xC0) != 0x80).sum())


def fill_in_middle(docs: DataFrame, settings: FimSettings = FimSettings()) -> DataFrame:
    """Each row of ``doc_id, text`` with its tokens, its form and the text put together anew.

    ``prefix_chars`` and ``middle_chars`` are null where the form is ``plain``.
    """
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def row(doc_id, text):
        raw = utf8(text)
        index = RankIndex.fit(boundaries(raw))
        n = len(index.residuals) - 1
        h1, h2, h3, h4 = draws(settings.seed, doc_id)
        if not raw or h3 % 100 >= settings.cut_percent or any(m in raw for m in marks):
            return doc_id, n, "plain", None, None, raw.decode("utf-8")
        begin, end = index.offsets(sorted((h1 % (n + 1), h2 % (n + 1)))).tolist()
        prefix, middle, suffix = raw[:begin], raw[begin:end], raw[end:]
        if h4 % 100 < settings.suffix_first_percent:
            form, parts = "spm", (marks[1], suffix, marks[0], prefix, marks[2], middle)
        else:
            form, parts = "psm", (marks[0], prefix, marks[1], suffix, marks[2], middle)
        return doc_id, n, form, _code_points(prefix), _code_points(middle), b"".join(parts).decode("utf-8")

    return map_rows(
        docs, ["doc_id", "text"], SCHEMA, lambda: lambda ids, texts: map(row, ids, texts), SLICE_BYTES
    )


def rank_indexes(docs: DataFrame) -> DataFrame:
    """The learned index of each row: segments as arrays, residuals as one byte a boundary."""

    def row(doc_id, text):
        index = RankIndex.fit(boundaries(utf8(text)))
        return doc_id, index.firsts, index.bases, index.slopes, index.residuals.tobytes()

    schema = "doc_id long, firsts array<long>, bases array<long>, slopes array<double>, residuals binary"
    return map_rows(
        docs, ["doc_id", "text"], schema, lambda: lambda ids, texts: map(row, ids, texts), SLICE_BYTES
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from.

    No sentinel occurs in a text that was cut, and none can arise across two parts,
    since no sentinel ends as it begins; so the first one found is the one put in.
    """

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        at, last = F.instr(output, second), F.instr(output, MIDDLE)
        begin = len(first) + 1
        one = F.substr(output, F.lit(begin), at - F.lit(begin))
        two = F.substr(output, at + F.lit(len(second)), last - at - F.lit(len(second)))
        return one, two, F.substr(output, last + F.lit(len(MIDDLE)))

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    late, early, inner = parts(SUFFIX, PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(early, inner, late))
        .otherwise(output)
    )
