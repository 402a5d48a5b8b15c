"""Plan a mix: how far to read every source, where the caps cut it, how long it is.

Planning reads only (source, doc_id, token count). What reaches the driver is one
row per source and one row per order bucket, of which there are at most
``MAX_BUCKETS``. The result describes the order of all documents completely, so
any task can compute the stream position of its documents from it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from blockmill.config import PackSettings, SourceSpec
from blockmill.operators.blocks import completed_blocks
from blockmill.operators.mixing import (
    ORDER, arrival_time, before_cut, repeat_epochs, source_stats, stream_offsets,
)
from blockmill.operators.prefix import MAX_BUCKETS, bucket_starts
from blockmill.plans.caps import SIGMAS, next_cuts
from blockmill.plans.measure import TokenSlices, record_keys
from blockmill.session import default_parallelism, small_table
from blockmill.sources.specs import validate_specs

# Fixed sizes: a slab is the share of the stream that one task packs. Their number
# is held down because every input split sends to every slab; past it slabs grow
# and spill. A bucket on a slab boundary is sent twice, so buckets are finer.
SLAB_TOKENS = 1 << 28
MAX_SLABS = 1 << 15
BUCKETS_PER_SLAB = 32
ROWS_PER_TASK = 1 << 20
MANY_EPOCHS = 32
# Records that a budget's first look takes, of all sources and of each one.
PILOT_RECORDS = 4096
PILOT_OF_SOURCE = 64


@dataclass(frozen=True)
class Cut:
    """The last document of a capped source, by its place in the order."""

    arrival: float
    epoch: int
    doc_id: int
    n_tok: int


@dataclass(frozen=True)
class Lane:
    """One source of the mix."""

    name: str
    weight: float
    token_cap: int | None
    n_records: int
    n_docs: int
    tokens: int
    longest: int
    # Arrivals from here on are left out; None where one epoch ends the source.
    end: float | None = None
    cut: Cut | None = None

    @property
    def epochs(self) -> int:
        """Epochs with an arrival before ``end``, by the arithmetic of the rows."""
        if self.end is None:
            return 1
        n = math.ceil(self.end * self.weight / self.n_records)
        while n * self.n_records / self.weight < self.end:
            n += 1
        while n > 1 and (n - 1) * self.n_records / self.weight >= self.end:
            n -= 1
        return max(1, n)

    @property
    def stop(self) -> float:
        """No document of the source arrives after this."""
        stop = self.n_records / self.weight if self.end is None else self.end
        return stop if self.cut is None else min(stop, self.cut.arrival)

    @property
    def token_rate(self) -> float:
        return self.weight * self.tokens / self.n_records


@dataclass(frozen=True, eq=False)
class MixPlan:
    """A settled mix: its lanes, and where every order bucket starts."""

    settings: PackSettings
    eos: bool
    lanes: tuple[Lane, ...]
    n_buckets: int
    buckets: np.ndarray = field(repr=False)
    starts: np.ndarray = field(repr=False)
    stream_tokens: int = 0
    n_blocks: int = 0
    # Records and ids of every source, where the tokens of a whole epoch are not known.
    keys: dict[str, tuple[int, int]] | None = field(default=None, repr=False)

    @property
    def inputs(self) -> dict[str, tuple[int, int]]:
        """What the sources are known by: records, and tokens of one epoch or ids."""
        return self.keys or {x.name: (x.n_records, x.tokens) for x in self.lanes}


# Terms of the curve that maps arrival times to order buckets.
MAX_KNOTS = 64

_CUT_COLUMNS = ("cut_arrival", "cut_epoch", "cut_doc", "cut_n_tok")


def _lane_table(spark: SparkSession, lanes: Sequence[Lane]) -> DataFrame:
    cuts = [x.cut for x in lanes]
    return small_table(spark, {
        "source": pa.array([x.name for x in lanes], pa.string()),
        "weight": pa.array([float(x.weight) for x in lanes], pa.float64()),
        "n_records": pa.array([x.n_records for x in lanes], pa.int64()),
        "epochs": pa.array([x.epochs for x in lanes], pa.int32()),
        "end_arrival": pa.array([x.end for x in lanes], pa.float64()),
        "cut_arrival": pa.array([c and c.arrival for c in cuts], pa.float64()),
        "cut_epoch": pa.array([c and c.epoch for c in cuts], pa.int32()),
        "cut_doc": pa.array([c and c.doc_id for c in cuts], pa.int64()),
        "cut_n_tok": pa.array([c and c.n_tok for c in cuts], pa.int64()),
    })


def _bucket_of(lanes: Sequence[Lane], n_buckets: int) -> Column:
    """Order bucket of an arrival time, with about equal work in every bucket.

    The expected work before time t is the sum of rate * min(t, stop) over the
    sources. It never falls as t grows, rounding included, so bucket numbers
    respect the order. Work weighs documents and tokens alike.
    """
    records = sum(x.n_records for x in lanes)
    tokens = max(1, sum(x.tokens for x in lanes))
    rate_by_stop: dict[float, float] = {}
    for x in lanes:
        rate = x.weight * (x.tokens / x.n_records * records / tokens + 1.0)
        rate_by_stop[x.stop] = rate_by_stop.get(x.stop, 0.0) + rate
    knots = sorted(rate_by_stop.items())
    if len(knots) > MAX_KNOTS:
        # Any curve that never falls gives the same order; neighbours share a knot, so
        # that the expression has a fixed size.
        size = math.ceil(len(knots) / MAX_KNOTS)
        parts = [knots[k: k + size] for k in range(0, len(knots), size)]
        knots = [(part[-1][0], sum(rate for _, rate in part)) for part in parts]
    total = sum(stop * rate for stop, rate in knots) or 1.0
    work = None
    for stop, rate in knots:
        term = F.least(F.col("arrival"), F.lit(stop)) * F.lit(rate * n_buckets / total)
        work = term if work is None else work + term
    return F.least(F.floor(work), F.lit(n_buckets - 1)).cast("int")


def _with_epochs(rows: DataFrame, lanes: Sequence[Lane]) -> DataFrame:
    """Every record once per epoch of its source.

    A small source that repeats very often may make up much of the mix while its
    records sit in one input split. It is spread over all tasks first, by runs of
    epochs, so that the copies are not made in one place.
    """
    most = max(x.epochs for x in lanes)
    if most == 1:
        # Always 0. A literal would drop out of the sort order of kept rows, which
        # then would not be seen to serve the windows over them.
        return rows.withColumn("epoch", F.col("epochs") - 1)
    often = [x.name for x in lanes if x.epochs > MANY_EPOCHS]
    if not often:
        return repeat_epochs(rows, F.col("epochs"))
    run = math.ceil(math.sqrt(most))
    n_parts = 4 * default_parallelism(rows.sparkSession)
    first = F.col("run") * run
    spread = (
        rows.filter(F.col("source").isin(often))
        .withColumn("run", F.explode(F.sequence(F.lit(0), F.ceil(F.col("epochs") / run).cast("int") - 1)))
        .repartition(n_parts, "source", "doc_id", "run")
        .withColumn("epoch", F.explode(F.sequence(first, F.least(first + run, F.col("epochs")) - 1)))
        .drop("run")
    )
    rest = repeat_epochs(rows.filter(~F.col("source").isin(often)), F.col("epochs"))
    return rest.unionByName(spread)


def placed_documents(
    docs: DataFrame, lanes: Sequence[Lane], settings: PackSettings, eos: bool, n_buckets: int
) -> DataFrame:
    """Every document of the mix with its place in the order and its length.

    ``docs`` has ``source``, ``doc_id``, ``n_tok`` and any payload columns. Rows
    without tokens leave after their pace was counted in the record total.
    """
    spark = docs.sparkSession
    raced = docs.filter(F.col("n_tok") > 0).join(_lane_table(spark, lanes), "source")
    raced = _with_epochs(raced, lanes)
    raced = raced.withColumn(
        "arrival", arrival_time(settings.seed, F.col("n_records"), F.col("weight"))
    )
    if any(x.end is not None for x in lanes):
        raced = raced.filter(
            F.col("end_arrival").isNull() | (F.col("arrival") < F.col("end_arrival"))
        )
    if any(x.cut is not None for x in lanes):
        raced = raced.filter(before_cut())
    return (
        raced.withColumn("len", F.col("n_tok") + F.lit(int(eos)).cast("long"))
        .withColumn("bucket", _bucket_of(lanes, n_buckets))
        .drop("weight", "n_records", "epochs", "end_arrival", *_CUT_COLUMNS)
    )


@dataclass(frozen=True, eq=False)
class _Order:
    """What a pass over all documents tells of the order buckets."""

    n_buckets: int
    # Numbers, latest arrivals, and stream starts with the end of the stream.
    buckets: np.ndarray
    latest: np.ndarray
    starts: np.ndarray


def _order(
    sizes: DataFrame, lanes: Sequence[Lane], settings: PackSettings, eos: bool
) -> _Order:
    n_buckets = _count_buckets(sizes.sparkSession, lanes, settings.seq_len)
    rows = placed_documents(sizes, lanes, settings, eos, n_buckets)
    table = rows.groupBy("bucket").agg(
        F.sum("len").cast("long").alias("tokens"), F.max("arrival").alias("latest")
    ).toArrow().sort_by("bucket")
    tokens = table["tokens"].to_numpy().astype(np.int64)
    return _Order(
        n_buckets,
        table["bucket"].to_numpy().astype(np.int64),
        table["latest"].to_numpy().astype(np.float64),
        np.concatenate([[0], np.cumsum(tokens)]).astype(np.int64),
    )


def _count_buckets(spark: SparkSession, lanes: Sequence[Lane], seq_len: int) -> int:
    tokens = sum(x.token_rate * x.stop for x in lanes)
    slabs = max(default_parallelism(spark), math.ceil(tokens / SLAB_TOKENS))
    slabs = min(slabs, MAX_SLABS, max(1, math.ceil(tokens / seq_len)))
    return min(MAX_BUCKETS, BUCKETS_PER_SLAB * slabs)


def next_cut(rows: DataFrame, lanes: Sequence[Lane], settings: PackSettings) -> tuple[str, Cut] | None:
    """The earliest document with which an uncut source reaches its cap, if any.

    ``rows`` are placed documents without those behind earlier cuts. A first pass
    finds the bucket by bucket sums, a second looks at that bucket only.
    """
    spark = rows.sparkSession
    open_caps = [x for x in lanes if x.token_cap is not None and x.cut is None]
    if not open_caps:
        return None
    caps = small_table(spark, {
        "source": pa.array([x.name for x in open_caps], pa.string()),
        "cap_blocks": pa.array(
            [-(-x.token_cap // settings.seq_len) for x in open_caps], pa.int64()
        ),
    })
    starts = bucket_starts(rows, "bucket", F.col("len"))
    done = completed_blocks(
        F.col("off"), F.col("len"), settings.seq_len, settings.budget_blocks
    )

    def with_blocks(part: DataFrame, part_starts: DataFrame) -> DataFrame:
        # The part of the stream behind the budget completes nothing.
        placed = stream_offsets(part, starts=part_starts)
        return placed.withColumn("k", done).filter(F.col("k") > 0).join(caps, "source")

    by_bucket = with_blocks(rows, starts).groupBy("source", "cap_blocks", "bucket").agg(
        F.sum("k").alias("k")
    )
    # At most MAX_BUCKETS aggregated rows per source.
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    crossing = (
        by_bucket.withColumn("seen", F.sum("k").over(upto))
        .filter(F.col("seen") >= F.col("cap_blocks"))
        .groupBy("source")
        .agg(F.min_by(F.struct("bucket", (F.col("seen") - F.col("k")).alias("before")), "bucket").alias("at"))
        .select("source", "at.bucket", "at.before")
        .join(F.broadcast(starts.select("bucket", "bucket_start")), "bucket")
        .collect()
    )
    if not crossing:
        return None
    bucket, start = min((r["bucket"], r["bucket_start"]) for r in crossing)
    before = {r["source"]: r["before"] for r in crossing if r["bucket"] == bucket}
    bases = small_table(spark, {
        "source": pa.array(list(before), pa.string()),
        "before": pa.array(list(before.values()), pa.int64()),
    })
    start_here = small_table(spark, {
        "bucket": pa.array([bucket], pa.int32()), "bucket_start": pa.array([start], pa.int64()),
    })
    inside = Window.partitionBy("source").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    first = (
        with_blocks(rows.filter(F.col("bucket") == bucket), start_here)
        .join(bases, "source")
        .withColumn("seen", F.col("before") + F.sum("k").over(inside))
        .filter(F.col("seen") >= F.col("cap_blocks"))
        .orderBy(*ORDER).select(*ORDER).first()
    )
    return first["source"], Cut(
        first["arrival"], first["epoch"], first["doc_id"], first["n_tok"]
    )


def _first_horizon(lanes: Sequence[Lane], wanted: float) -> float:
    """Arrival time by which the sources are expected to give ``wanted`` tokens."""
    open_ends = [
        (x.token_cap / x.token_rate if x.token_cap is not None else math.inf, x.token_rate)
        for x in lanes
    ]
    reached, time = 0.0, 0.0
    for stop in sorted({stop for stop, _ in open_ends}):
        rate = sum(r for s, r in open_ends if s > time)
        if reached + rate * (stop - time) >= wanted:
            return time + (wanted - reached) / rate
        reached, time = reached + rate * (stop - time), stop
    return time


def _guess_end(lane: Lane, horizon: float) -> float:
    """A little more than a source needs to reach its cap or the horizon."""
    if lane.token_cap is None:
        return horizon
    return min(horizon, (1.1 * lane.token_cap + 2 * lane.longest) / lane.token_rate)


def plan_mix(
    sizes: DataFrame, specs: Sequence[SourceSpec], settings: PackSettings, eos: bool = True
) -> MixPlan:
    """Settle epochs, caps and bucket starts for one mix.

    ``sizes`` has one row per record: source, doc_id and token count, 0 for
    records that cannot be used. It is read several times, so it is kept for the
    time of planning; it carries no text.
    """
    validate_specs(specs)
    spark = sizes.sparkSession
    sizes = sizes.select("source", "doc_id", "n_tok").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        lanes = _lanes(sizes, specs, eos)
        if settings.total_tokens is None:
            lanes = _settle_caps(sizes, lanes, settings, eos)
            order = _order(sizes, lanes, settings, eos)
        else:
            lanes, order = _settle_budget(lambda _: sizes, lanes, settings, eos)
    finally:
        sizes.unpersist()
    return _settled(settings, eos, lanes, order)


def _settled(
    settings: PackSettings, eos: bool, lanes: Sequence[Lane], order: _Order, keys=None
) -> MixPlan:
    total = int(order.starts[-1])
    n_blocks = total // settings.seq_len
    if settings.budget_blocks is not None:
        n_blocks = min(n_blocks, settings.budget_blocks)
    return MixPlan(
        settings, eos, tuple(lanes), order.n_buckets, order.buckets, order.starts, total, n_blocks, keys
    )


def plan_budget(
    slices: TokenSlices, specs: Sequence[SourceSpec], settings: PackSettings, eos: bool = True
) -> MixPlan:
    """The same plan for a token budget, from the documents that the budget reaches.

    Record counts set the pace of every source, as always. A first slice of each tells
    about how many tokens a record has, which gives a horizon; the documents before it
    are tokenised, and more of them only where the budget is not filled yet. What a
    whole epoch holds is an estimate that decides nothing but how far is read at first.
    """
    validate_specs(specs)
    wanted = {s.name: s for s in specs if s.weight > 0}
    keys = record_keys(slices.docs, list(wanted))
    records = {name: keys.get(name, (0, 0))[0] for name in wanted}
    time = PILOT_RECORDS / sum(s.weight for s in wanted.values())
    shares = {
        name: max(time * s.weight, PILOT_OF_SOURCE) / max(records[name], 1) for name, s in wanted.items()
    }
    while True:
        stats = {r["source"]: r for r in source_stats(slices.reach(shares), eos).collect()}
        silent = [n for n in wanted if n not in stats or stats[n]["n_docs"] == 0]
        for name in silent:
            if slices.shares[name] >= 1 or not records[name]:
                raise ValueError(f"source {name} has no usable text")
            shares[name] = 8 * slices.shares[name]
        if not silent:
            break
    lanes = []
    for name, s in wanted.items():
        r, n = stats[name], records[name]
        whole = [max(1, round(r[c] * n / r["n_records"])) for c in ("n_docs", "tokens")]
        lanes.append(Lane(name, float(s.weight), s.token_cap, n, *whole, r["longest"]))

    def upto(now: Sequence[Lane]) -> DataFrame:
        # Rounding may not leave out a document that arrives before the end.
        ends = {x.name: x.end * x.weight / x.n_records * (1 + 1e-9) for x in now}
        return slices.reach(ends).select("source", "doc_id", "n_tok")

    lanes, order = _settle_budget(upto, lanes, settings, eos)
    return _settled(settings, eos, lanes, order, keys)


def _lanes(sizes: DataFrame, specs: Sequence[SourceSpec], eos: bool) -> list[Lane]:
    wanted = {s.name: s for s in specs if s.weight > 0}
    stats = source_stats(sizes.filter(F.col("source").isin(*wanted)), eos).collect()
    found = {r["source"]: r for r in stats}
    lanes = []
    for name, s in wanted.items():
        r = found.get(name)
        if r is None or r["n_docs"] == 0:
            raise ValueError(f"source {name} has no usable text")
        lanes.append(Lane(
            name, float(s.weight), s.token_cap, r["n_records"], r["n_docs"], r["tokens"], r["longest"]
        ))
    return lanes


def _settle_caps(
    sizes: DataFrame, lanes: list[Lane], settings: PackSettings, eos: bool
) -> list[Lane]:
    """Find the cut of every source that reaches its cap, earliest first.

    What comes before a cut does not depend on later cuts. ``next_cuts`` finds all of
    them in one go as a rule; where it stops early, ``next_cut`` takes a single one for
    certain, and the windows grow. Stops when a cut would lie beyond the part of the
    order that has been read; the caller then reads further.
    """
    if all(x.token_cap is None or x.cut is not None for x in lanes):
        return lanes
    spark = sizes.sparkSession
    n_buckets = _count_buckets(spark, lanes, settings.seq_len)
    rows = placed_documents(sizes, lanes, settings, eos, n_buckets)
    # Kept partitioned and sorted: no round shuffles or sorts the documents again.
    documents = sum(x.weight * x.stop for x in lanes)
    n_parts = min(n_buckets, max(default_parallelism(spark), math.ceil(documents / ROWS_PER_TASK)))
    rows = rows.repartition(n_parts, "bucket").sortWithinPartitions("bucket", *ORDER)
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    sigmas = SIGMAS
    try:
        while True:
            cut_so_far = _lane_table(spark, lanes).select("source", *_CUT_COLUMNS)
            kept = rows.join(cut_so_far, "source").filter(before_cut()).select(*rows.columns)
            caps = {
                x.name: -(-x.token_cap // settings.seq_len)
                for x in lanes if x.token_cap is not None and x.cut is None
            }
            found, all_found = next_cuts(kept, caps, settings.seq_len, settings.budget_blocks, sigmas)
            cuts = [(name, Cut(*place)) for name, *place in found]
            if not cuts and not all_found:
                one = next_cut(kept, lanes, settings)
                if one is None:
                    return lanes
                cuts = [one]
            for name, cut in cuts:
                if any(x.end is not None and x.cut is None and x.end <= cut.arrival for x in lanes):
                    return lanes
                lanes = [replace(x, cut=cut) if x.name == name else x for x in lanes]
            if all_found:
                return lanes
            sigmas *= 4
    finally:
        rows.unpersist()


def _settle_budget(
    upto: Callable[[Sequence[Lane]], DataFrame], lanes: list[Lane], settings: PackSettings, eos: bool
) -> tuple[list[Lane], _Order]:
    """Read far enough into the repeating sources to fill the token budget.

    Arrival times do not depend on how far is read, so a second try with a later
    horizon continues the same order. ``upto`` gives the sizes of all documents
    before the ends of the lanes.
    """
    wanted = settings.budget_blocks * settings.seq_len
    slack = 0.02 * wanted + 2 * max(x.longest for x in lanes)
    horizon = _first_horizon(lanes, wanted + slack)
    lanes = [replace(x, end=_guess_end(x, horizon)) for x in lanes]
    while True:
        sizes = upto(lanes)
        lanes = _settle_caps(sizes, lanes, settings, eos)
        order = _order(sizes, lanes, settings, eos)
        uncut = [x for x in lanes if x.cut is None]
        if not uncut:
            return lanes, order
        have = int(order.starts[-1])
        if have >= wanted:
            # The order must be complete up to the document that fills the budget.
            frontier = order.latest[int(np.searchsorted(order.starts[1:], wanted))]
            short = {x.name for x in uncut if x.end <= frontier}
            if not short:
                return lanes, order
        else:
            horizon *= min(4.0, 1.1 * wanted / max(have, 1))
            short = {x.name for x in uncut}
        lanes = [
            replace(x, end=horizon if x.token_cap is None else min(horizon, 2 * x.end))
            if x.name in short else x
            for x in lanes
        ]
