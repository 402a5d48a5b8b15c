"""Sharding by best-fit decreasing: groups of rows into the fewest shards of one capacity.

Rows with equal texts form a group and go to one shard. Groups sorted by size enter,
largest first, the shard whose remaining capacity fits them most tightly; the
shards stand in a balanced tree by remaining capacity, so each step is a search. The
capacity is the smallest found for which the groups need at most ``n_shards`` shards,
which also makes the shards nearly equal.

Placing is sequential, so it sees a bounded number of items whatever the corpus:

* a group of at least 1 / ``grain`` of a shard's even share is an item: at most
  ``n_shards * grain`` of them exist;
* smaller groups are gathered by hash into ``n_shards * grain`` bundles, each an item;
* a group larger than a whole even share cannot stay together in equal shards; it is dealt
  by ``doc_id`` into parts of about the size of a bundle (rows with one ``doc_id`` stay together).

All sizes are exact sums over all rows. Rows find their shard by two broadcasts with
that bound, so no text and no group is ever shuffled. A row's place (``slot``) is a
running count over parts of each shard, not a sort of the shard.

Null text: none, size 1, like the empty text but a group of its own. Null ``doc_id`` stays
null. Repeated rows each have a place. Further columns are not read. An empty table gives
an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from blockmill.operators.prefix import running_start_by_group
from blockmill.session import small_table, stored

ROWS_PER_PART = 4096
BUNDLE, GROUP, PART = 0, 1, 2


@dataclass(frozen=True)
class ShardSettings:
    n_shards: int = 16
    grain: int = 128

    def __post_init__(self):
        if self.n_shards < 1 or self.grain < 1 or 2 * self.n_shards * self.grain > 1 << 20:
            raise ValueError("n_shards and grain at least 1, 2 * n_shards * grain at most 2^20")


class CapacityTree:
    """Shards by remaining capacity: an AA tree of (remaining, shard) keys."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None  # a node is [key, level, left, right]

    @staticmethod
    def _skew(t):
        if t and t[2] and t[2][1] == t[1]:
            left = t[2]
            t[2], left[3] = left[3], t
            return left
        return t

    @staticmethod
    def _split(t):
        if t and t[3] and t[3][3] and t[1] == t[3][3][1]:
            right = t[3]
            t[3], right[2] = right[2], t
            right[1] += 1
            return right
        return t

    def insert(self, key):
        def add(t):
            if t is None:
                return [key, 1, None, None]
            side = 2 if key < t[0] else 3
            t[side] = add(t[side])
            return self._split(self._skew(t))

        self.root = add(self.root)

    def remove(self, key):
        def level(t):
            return t[1] if t else 0

        def drop(t, key):
            if t is None:
                return None
            if key < t[0]:
                t[2] = drop(t[2], key)
            elif key > t[0]:
                t[3] = drop(t[3], key)
            elif t[2] is None and t[3] is None:
                return None
            elif t[2] is None:
                after = t[3]
                while after[2]:
                    after = after[2]
                t[3] = drop(t[3], after[0])
                t[0] = after[0]
            else:
                before = t[2]
                while before[3]:
                    before = before[3]
                t[2] = drop(t[2], before[0])
                t[0] = before[0]
            should = min(level(t[2]), level(t[3])) + 1
            if should < t[1]:
                t[1] = should
                if t[3] and should < t[3][1]:
                    t[3][1] = should
            t = self._skew(t)
            if t[3]:
                t[3] = self._skew(t[3])
                if t[3][3]:
                    t[3][3] = self._skew(t[3][3])
            t = self._split(t)
            if t[3]:
                t[3] = self._split(t[3])
            return t

        self.root = drop(self.root, key)

    def tightest(self, size: int):
        """The smallest key with at least this remaining capacity, or None."""
        t, best = self.root, None
        while t:
            if t[0][0] >= size:
                best, t = t[0], t[2]
            else:
                t = t[3]
        return best


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The shard of each item; None if an item or, with ``most``, their number is too large."""
    tree, shards, opened = CapacityTree(), [0] * len(sizes), 0
    for k in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[k]
        key = tree.tightest(size)
        if key is None:
            if size > capacity or opened == most:
                return None
            key, opened = (capacity, opened), opened + 1
        else:
            tree.remove(key)
        shards[k] = key[1]
        tree.insert((key[0] - size, key[1]))
    return shards


def tight_shards(sizes: list[int], n_shards: int) -> tuple[int, list[int]]:
    """The smallest capacity found for which ``n_shards`` shards are enough, and the shards."""
    if not sizes:
        return 0, []
    low = max(-(-sum(sizes) // n_shards), max(sizes))
    high, best = low, best_fit_decreasing(sizes, low, n_shards)
    while best is None:
        low, high = high + 1, high + max(1, high // 64)
        best = best_fit_decreasing(sizes, high, n_shards)
    while low < high and high - low > high >> 14:
        middle = (low + high) // 2
        found = best_fit_decreasing(sizes, middle, n_shards)
        if found is None:
            low = middle + 1
        else:
            best, high = found, middle
    return high, best


# Parts of the rows of one text and id, for numbering them.
_PLACE_PARTS = 64


def _items(rows: DataFrame, heavy: DataFrame, n_items: int) -> DataFrame:
    """The rows with the item (``kind``, ``a``, ``b``) that each belongs to."""
    joined = rows.join(heavy, rows["grp"] == heavy["heavy"], "left")
    kind = F.when(F.col("parts") > 1, PART).when(F.col("parts") == 1, GROUP).otherwise(BUNDLE)
    a = F.coalesce("heavy", F.pmod("grp", F.lit(n_items)))
    dealt = joined.filter(F.col("parts") > 1).withColumn("named", F.xxhash64("grp", "doc_id"))
    # Rows of one text under one id, or without one, are alike; they are dealt by their place.
    place = running_start_by_group(
        dealt, "named", F.pmod("position", F.lit(_PLACE_PARTS)), ["position"], F.lit(1), "place"
    )
    b = F.pmod(F.xxhash64("doc_id") + F.col("place"), F.col("parts"))
    dealt = place.withColumn("b", b).drop("named", "place")
    whole = joined.filter(F.coalesce("parts", F.lit(0)) <= 1).withColumn("b", F.lit(0).cast("long"))
    rows = whole.unionByName(dealt)
    return rows.withColumns({"kind": kind, "a": a}).drop("heavy", "parts", "position")


def assign_shards(docs: DataFrame, settings: ShardSettings = ShardSettings()) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row of ``doc_id, text``."""
    spark = docs.sparkSession
    body = F.coalesce("text", F.lit("")).cast("binary")
    rows = stored(docs.select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64("text").alias("grp"),
    ), "sizes")
    # Where a row lies in the written table; it tells alike rows apart and nothing else.
    rows = rows.withColumn("position", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    n_rows, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    even = -(-(total or 0) // settings.n_shards)
    least = max(1, even // settings.grain)
    n_items = settings.n_shards * settings.grain
    # Sums of at least ``least`` each: at most n_shards * grain + 1 rows.
    large = rows.groupBy("grp").agg(F.sum("size").alias("size")).filter(F.col("size") >= least).collect()
    heavy = small_table(spark, {
        "heavy": pa.array([g for g, _ in large], pa.int64()),
        "parts": pa.array([-(-s // least) if s > even else 1 for _, s in large], pa.int64()),
    })
    placed = _items(rows, heavy, n_items)
    # At most one row for each large group, part of one and bundle.
    items = sorted(map(tuple, placed.groupBy("kind", "a", "b").agg(F.sum("size").alias("size")).collect()))
    _, shards = tight_shards([i[3] for i in items], settings.n_shards)
    route = small_table(spark, {
        "kind": pa.array([i[0] for i in items], pa.int32()),
        "a": pa.array([i[1] for i in items], pa.int64()),
        "b": pa.array([i[2] for i in items], pa.int64()),
        "shard": pa.array(shards, pa.int32()),
    })
    routed = placed.join(route, ["kind", "a", "b"]).select("doc_id", "size", "text_crc32", "shard")
    parts = 1 + n_rows // (settings.n_shards * ROWS_PER_PART)
    part: Column = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts))
    return running_start_by_group(routed, "shard", part, ["doc_id", "text_crc32"], F.lit(1), "slot")
