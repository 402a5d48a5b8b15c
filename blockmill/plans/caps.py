"""All cuts of capped sources in two jobs, however many sources have a cap.

Where a source reaches its cap depends on the blocks that its documents complete, so on
their place in the stream, and that on every earlier cut. Still the order need not be
walked once for each cut:

* A source has completed about as many blocks as its tokens fill. Sums by order bucket so
  tell a *window* of buckets for its cut, wide enough for the rounding of all its documents.
* Between windows nobody is cut. There the blocks that a source completes are a function of
  the offset at which the stretch begins, modulo the block length: a document of ``len``
  tokens completes ``len div L`` blocks, and one more if that offset lies in a
  certain range. Counts of range ends, at most ``L`` for a source, hold the whole function.
* One task walks over the stretches by these counts, and over the documents of the windows
  one by one, where it finds the exact cuts.

What the walk reads is bounded by windows and block length, not by the corpus. A
source that comes to its cap outside its window stops the walk; what was found before is
right, and the caller goes on from there with wider windows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from blockmill.operators.blocks import whole_div
from blockmill.operators.mixing import ORDER
from blockmill.operators.prefix import running_start
from blockmill.session import small_table

# Half a window, in standard deviations of a source's completed blocks.
SIGMAS = 6.0
_FOUND = "source string, arrival double, epoch int, doc_id long, n_tok long"
_TOTAL, _BASE = -2, -1


def cut_windows(
    rows: DataFrame, caps: dict[str, int], seq_len: int, sigmas: float
) -> dict[str, tuple[int, int, bool]]:
    """First and last order bucket in which each source may reach its cap (in blocks).

    Sources that stay below their caps have none; whether a source is sure to reach it
    comes third. One row a source reaches the driver.
    """
    spark = rows.sparkSession
    table = small_table(spark, {
        "source": pa.array(list(caps), pa.string()),
        "cap_blocks": pa.array(list(caps.values()), pa.int64()),
    })
    sums = rows.join(table, "source").groupBy("source", "cap_blocks", "bucket").agg(
        F.sum("len").alias("tokens"), F.count("*").alias("docs")
    )
    # At most one row per source and bucket.
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.sum("tokens").over(upto) / seq_len
    spread = F.lit(sigmas / 2) * F.sqrt(F.sum("docs").over(upto)) + 2
    found = (
        sums.withColumn("low", seen + spread >= F.col("cap_blocks")).withColumn("high", seen - spread >= F.col("cap_blocks"))
        .groupBy("source").agg(
            F.min(F.when(F.col("low"), F.col("bucket"))).alias("first"),
            F.min(F.when(F.col("high"), F.col("bucket"))).alias("last"),
            F.max("bucket").alias("end"),
        ).collect()
    )
    return {
        r["source"]: (r["first"], r["end"] if r["last"] is None else r["last"], r["last"] is not None)
        for r in found if r["first"] is not None
    }


def _segments(windows: dict[str, tuple[int, int, bool]]) -> list[tuple[int, int, list[str]]]:
    """Windows that overlap as one, in order: first and last bucket, and the sources in it."""
    merged: list[tuple[int, int, list[str]]] = []
    for source, (first, last, _) in sorted(windows.items(), key=lambda x: x[1]):
        if merged and first <= merged[-1][1]:
            begin, end, names = merged[-1]
            merged[-1] = (begin, max(end, last), [*names, source])
        else:
            merged.append((first, last, [source]))
    return merged


def next_cuts(
    rows: DataFrame, caps: dict[str, int], seq_len: int, limit: int | None, sigmas: float = SIGMAS
) -> tuple[list[tuple[str, float, int, int, int]], bool]:
    """Cuts in order, as (source, arrival, epoch, doc_id, n_tok), and whether they are all.

    ``rows`` are placed documents without those behind earlier cuts; ``caps`` are the
    blocks that sources not yet cut may complete. ``limit`` ends the stream.
    """
    if not caps:
        return [], True
    spark = rows.sparkSession
    windows = cut_windows(rows, caps, seq_len, sigmas)
    segments = _segments(windows)
    if not segments:
        return [], True
    # Odd numbers are windows, even ones the stretches before them; what comes after the
    # last window is not needed.
    firsts, lasts = (np.array([s[k] for s in segments]) for k in (0, 1))
    buckets = np.arange(lasts[-1] + 1)
    before = np.searchsorted(lasts, buckets, side="left")
    inside = np.searchsorted(firsts, buckets, side="right") > before
    numbers = small_table(spark, {
        "bucket": pa.array(buckets, pa.int32()), "segment": pa.array(2 * before + inside, pa.int32()),
    })
    gone = {name: 2 * k + 2 for k, (_, _, names) in enumerate(segments) for name in names}
    bounds = small_table(spark, {
        "source": pa.array(list(gone), pa.string()), "gone": pa.array(list(gone.values()), pa.int32()),
    })
    placed = (
        rows.join(numbers, "bucket").join(bounds, "source", "left")
        .filter(F.col("gone").isNull() | (F.col("segment") < F.col("gone")))
    )
    walked = F.col("segment") % 2 == 1
    documents = placed.filter(walked).select("segment", *ORDER, "len")
    functions = _block_functions(placed.filter(~walked), list(caps), seq_len)
    merged = documents.unionByName(functions, allowMissingColumns=True)
    steps = merged.repartition(1).sortWithinPartitions("segment", *ORDER)
    sure = [[name for name in s[2] if windows[name][2]] for s in segments]
    walk = _Walk(caps, sure, seq_len, np.iinfo(np.int64).max if limit is None else limit)
    found = steps.mapInArrow(walk.run, _FOUND).collect()
    return [tuple(r) for r in found if r["source"] is not None], any(r["source"] is None for r in found)


def _block_functions(rows: DataFrame, sources: list[str], seq_len: int) -> DataFrame:
    """Completed blocks of each source in each segment, as a function of its first offset.

    Rows ``at``, ``delta``: the blocks at offset 0, changes at further offsets, and the
    tokens of all sources.
    """
    totals = rows.groupBy("segment", "bucket").agg(F.sum("len").cast("long").alias("bucket_sum"))
    before = Window.partitionBy("segment").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("bucket", F.coalesce(F.sum("bucket_sum").over(before), F.lit(0)).cast("long").alias("bucket_start"))
    placed = running_start(rows, "bucket", list(ORDER), F.col("len"), "inner", starts)
    length = F.lit(seq_len).cast("long")
    rest, at = F.pmod("len", length), F.pmod("inner", length)
    begin, end = F.pmod(length - rest - at, length), F.pmod(length - at, length)
    wraps = (rest > 0) & (begin > end) & (end > 0)

    def entry(source: Column, where: Column | int, delta: Column) -> Column:
        where = F.lit(where) if isinstance(where, int) else where
        return F.struct(source.alias("source"), where.cast("long").alias("at"), delta.cast("long").alias("delta"))

    name, one = F.col("source"), F.lit(1)
    own = F.array(
        entry(name, _BASE, whole_div(F.col("len"), seq_len) + wraps.cast("long")),
        entry(name, begin, F.when(rest > 0, one).otherwise(0)),
        entry(name, end, F.when((rest > 0) & (end > 0), -one).otherwise(0)),
    )
    total = F.array(entry(F.lit(""), _TOTAL, F.col("len")))
    entries = F.when(name.isin(sources), F.concat(own, total)).otherwise(total)
    return (
        placed.select("segment", F.inline(entries)).filter(F.col("delta") != 0)
        .groupBy("segment", "source", "at").agg(F.sum("delta").cast("long").alias("delta"))
    )


class _Walk:
    """One task's way through segments in order.

    ``sure`` names for every window the sources that must be cut in it: what follows takes
    it for granted. Others of the window may end below their caps, and have no
    documents behind it.
    """

    def __init__(self, caps: dict[str, int], sure: list[list[str]], seq_len: int, limit: int):
        self.caps, self.sure, self.seq_len, self.limit = caps, sure, seq_len, limit

    def run(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        self.offset, self.done, self.cut = 0, dict.fromkeys(self.caps, 0), set()
        found: list[tuple] = []
        for number, rows in _by_segment(batches):
            if number % 2:
                self._inside(rows, found)
                as_planned = self._past_limit() or all(s in self.cut for s in self.sure[number // 2])
            else:
                as_planned = self._along(rows)
            if not as_planned or self._past_limit():
                break
        if as_planned:
            # A row of nulls says that there are no more.
            found.append((None,) * 5)
        columns = list(zip(*found)) or [()] * 5
        types = (pa.string(), pa.float64(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["source", "arrival", "epoch", "doc_id", "n_tok"]
        )

    def _past_limit(self) -> bool:
        return self.offset // self.seq_len >= self.limit

    def _along(self, rows: pa.Table) -> bool:
        """Over a stretch by its functions; false if a source reaches its cap in it."""
        at = self.offset % self.seq_len
        for source, where, delta in zip(*(rows[c].to_pylist() for c in ("source", "at", "delta"))):
            if where == _TOTAL:
                self.offset += delta
            elif where <= at:
                self.done[source] += delta
        return all(n < self.caps[s] for s, n in self.done.items() if s not in self.cut)

    def _inside(self, rows: pa.Table, found: list[tuple]) -> None:
        """Over the documents of a window, one cut after the other."""
        coded = rows["source"].combine_chunks().dictionary_encode()
        names, source = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        length = rows["len"].to_numpy()
        first = 0
        while True:
            live = np.flatnonzero(~np.isin(source, [k for k, n in enumerate(names) if n in self.cut]))
            live = live[live >= first]
            ends = self.offset + np.cumsum(length[live])
            begins = ends - length[live]
            upto, before = (np.minimum(x // self.seq_len, self.limit) for x in (ends, begins))
            blocks = upto - before
            earliest = None
            for code, name in enumerate(names):
                if name not in self.caps or name in self.cut:
                    continue
                own = np.flatnonzero((source[live] == code) & (blocks > 0))
                reached = np.flatnonzero(self.done[name] + np.cumsum(blocks[own]) >= self.caps[name])
                if len(reached) and (earliest is None or own[reached[0]] < earliest[0]):
                    earliest = (int(own[reached[0]]), name)
            stop = len(live) if earliest is None else earliest[0] + 1
            for code, name in enumerate(names):
                if name in self.caps:
                    self.done[name] += int(blocks[:stop][source[live[:stop]] == code].sum())
            if stop:
                self.offset = int(ends[stop - 1])
            if earliest is None:
                return
            row = int(live[earliest[0]])
            found.append((earliest[1], *(rows[c][row].as_py() for c in ("arrival", "epoch", "doc_id", "n_tok"))))
            self.cut.add(earliest[1])
            first = row + 1


def _by_segment(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each segment together; batches come in order of the segment."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        numbers = batch.column("segment").to_numpy()
        cuts = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and held[-1].column("segment")[0].as_py() != int(numbers[a]):
                yield held[0].column("segment")[0].as_py(), pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield held[0].column("segment")[0].as_py(), pa.Table.from_batches(held)
