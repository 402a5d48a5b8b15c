"""What the operators share: words, Arrow passes, packed integers.

A word is ``[^\\x20\\x09-\\x0D]+``. Python's ``bytes.split`` cuts at exactly
those six bytes, so words are taken from the UTF-8 form of a text. A null text
is the empty text everywhere in this package.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows of a batch turned into Python objects at a time.
SLICE = 256
SPACES = " \t\n\x0b\x0c\r"


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8")


def words(text: str | None) -> list[bytes]:
    return utf8(text).split()


def code_points_in_words(text: str) -> int:
    return len(text) - sum(text.count(c) for c in SPACES)


def rows_of(batches: Iterable[pa.RecordBatch], max_bytes: int | None = None) -> Iterator[list]:
    """Columns of the batches as Python lists, a slice of rows at a time.

    With ``max_bytes`` a slice ends before it holds more, unless one row does.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            piece = batch.slice(start, SLICE)
            for part in [piece] if max_bytes is None else _by_bytes(piece, max_bytes):
                yield [column.to_pylist() for column in part.columns]


def _by_bytes(rows: pa.RecordBatch, max_bytes: int) -> Iterator[pa.RecordBatch]:
    sizes = np.zeros(rows.num_rows, np.int64)
    for column in rows.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, first = np.cumsum(sizes), 0
    while first < len(ends):
        before = int(ends[first - 1]) if first else 0
        after = max(first + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield rows.slice(first, after - first)
        first = after


def give_back() -> None:
    """Return to the system what a task of this process has freed.

    A worker process goes on to tasks of later stages, beside the tables of which
    the allocators would keep the pages of the earlier ones.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    # The C library's allocator, where it has such a call.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same task; when it ends, its tables leave the process."""

    def run(batches):
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def map_columns(
    df: DataFrame, columns: list[str], schema: T.StructType | str,
    make: Callable[[], Callable[..., Sequence]], max_bytes: int | None = None,
) -> DataFrame:
    """Rows made by a Python function that is itself made once a task.

    ``make()`` returns a function of the named columns, each a list over a slice of
    rows; it gives the output columns. Only the named columns reach Python.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = make()
        for values in rows_of(batches, max_bytes):
            out = made(*values)
            if len(out) and len(out[0]):
                arrays = [pa.array(c, f.type) for c, f in zip(out, arrow)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.select(*columns).mapInArrow(tidy(run), schema)


def map_rows(
    df: DataFrame, columns: list[str], schema: T.StructType | str,
    make: Callable[[], Callable[..., Iterable[tuple]]], max_bytes: int | None = None,
) -> DataFrame:
    """The same for a function that gives the output row by row, as tuples."""

    def as_columns():
        rows = make()
        return lambda *values: list(zip(*rows(*values)))

    return map_columns(df, columns, schema, as_columns, max_bytes)


def set_aside(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with other names for columns that begin as working columns do, and the way back."""
    back: dict[str, str] = {}
    for name in df.columns:
        if name.startswith("__"):
            other = "own" + name
            while other in df.columns or other in back:
                other = "own" + other
            back[other] = name
    return df.withColumnsRenamed({name: other for other, name in back.items()}), back


class WordTable:
    """Numbers for words and a short list of integers for each, encoded many at a time.

    ``encode`` gives a list for each word, or all integers in one array and the
    lists' lengths in another.

    Starts afresh when it holds too many words, so its memory is bounded by ``size``
    and one slice of rows. Numbers are stable between two calls of ``learn``.
    """

    def __init__(self, encode: Callable[[list], list[list[int]] | tuple[np.ndarray, np.ndarray]], size: int):
        self._encode, self._size = encode, size
        self._clear()

    def _clear(self) -> None:
        self._number: dict = {}
        self._values = np.zeros(1 << 16, np.int64)
        self._starts = np.zeros(1, np.int64)

    def learn(self, texts: Iterable[list]) -> None:
        """Make all words of the texts known; each text is a list of words."""
        known = self._number
        new = [w for w in dict.fromkeys(chain.from_iterable(texts)) if w not in known]
        if known and len(known) + len(new) > self._size:
            self._clear()
            return self.learn(texts)
        if not new:
            return
        made = self._encode(new)
        if isinstance(made, tuple):
            flat, sizes = made
        else:
            sizes = np.fromiter(map(len, made), np.int64, len(made))
            flat = np.fromiter(chain.from_iterable(made), np.int64, int(sizes.sum()))
        used = int(self._starts[-1])
        total = used + len(flat)
        if total > len(self._values):
            self._values = np.concatenate([self._values[:used], np.zeros(total, np.int64)])
        self._values[used:total] = flat
        self._starts = np.concatenate([self._starts, used + np.cumsum(sizes)])
        known.update(zip(new, range(len(known), len(known) + len(new))))

    def numbers(self, tokens: list) -> np.ndarray:
        return np.fromiter(map(self._number.__getitem__, tokens), np.int64, len(tokens))

    def values(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of these words, one after another, and how long each is."""
        first = self._starts[numbers]
        sizes = self._starts[numbers + 1] - first
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self._values[np.repeat(first - ends + sizes, sizes) + np.arange(total)], sizes


def window_ids(ids: np.ndarray, size: int) -> np.ndarray:
    """A number for each window of ``size`` (a power of two) ids; equal only for equal windows."""
    width = 1
    while width < size and len(ids) > width:
        pair = ids[:-width] * (int(ids.max()) + 1) + ids[width:]
        ids = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        width *= 2
    return ids if width == size else ids[:0]


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a window that begins at one of ``starts``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step[:n]) > 0
