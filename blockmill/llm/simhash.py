"""SimHash near-duplicates, by generalised pigeonhole search.

A fingerprint has 64 bits: bit *i* is set if more than half of the text's shingle
hashes have it set. Two fingerprints link at ``max_bits`` or fewer differing bits;
groups are the connected components of these links.

Search works on distinct fingerprints, so a group of exact copies is one node
whatever its size.

1. *Partitions.* Bits that vary together are put into the same partition (from
   64 x 64 counts over all distinct fingerprints).
2. *Thresholds.* Partition *i* gets a threshold t_i, -1 meaning "not searched",
   with sum(t_i + 1) = max_bits + 1. By the general pigeonhole principle, two
   fingerprints that link differ in at most t_i bits of some partition. Dynamic
   programming picks the thresholds (and the number of partitions) that cost
   least: probes sent plus expected candidates, the latter from the chance that
   two fingerprints differ in few bits of the partition.
3. *Probe.* A fingerprint is filed under its value in each searched partition and
   asks for all values within the threshold.
4. *Verify.* Candidates are kept if all 64 bits differ in ``max_bits`` or fewer.

A value shared by more than ``bucket`` fingerprints (a large group of near copies)
would make all pairs. Its fingerprints take another exact way: each names all
points within ``max_bits / 2`` bits of itself, and two link exactly if they name a
common point. No point can have more than 65 of them (at two bits), so the work is
linear in the size of the group.

Null text: as empty. A text with fewer words than a shingle is one shingle of all
its words; without words the fingerprint is zero, linked like any other. Null
``doc_id``: grouped like others, never the name of a group (null if the group has no
other). Repeated rows: repeated results. Further columns are not read. An empty
table gives an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from blockmill.llm.graph import components
from blockmill.llm.texts import map_rows, set_aside, tidy, utf8
from blockmill.session import stored

BITS = 64
SEED = 42
_CHUNK = 1 << 15

# Labels of fingerprints that more than one row in so many has are broadcast.
HEAVY_SHARE = 1 << 16


@dataclass(frozen=True)
class SimHashSettings:
    """``bucket``: fingerprints under one value that are compared in pairs."""

    shingle: int = 3
    max_bits: int = 2
    bucket: int = 256

    def __post_init__(self):
        if self.shingle < 1 or self.max_bits < 0 or self.max_bits % 2:
            raise ValueError("shingle must be positive, max_bits even")


def fingerprint(raw: bytes, shingle: int) -> int:
    """The unsigned fingerprint of a UTF-8 text."""
    import xxhash

    words = raw.lower().split()  # bytes.lower changes A-Z only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    size = min(shingle, len(words))
    first = np.concatenate([[0], ends[: len(words) - size]]).tolist()
    last = (ends[size - 1:] - 1).tolist()
    hash64, total = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for start in range(0, len(first), _CHUNK):
        spans = zip(first[start: start + _CHUNK], last[start: start + _CHUNK])
        hashes = np.array([hash64(line[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * total > len(first), bitorder="little")
    return int(packed.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, body, fp`` of every row of ``doc_id, text``.

    ``body`` is a hash of the text, which tells rows of one id apart; ``fp`` is a signed long.
    """

    def make():
        def rows(doc_ids, bodies, texts):
            for doc_id, body, text in zip(doc_ids, bodies, texts):
                value = fingerprint(utf8(text), shingle)
                yield doc_id, body, value - (1 << 64) if value >> 63 else value

        return rows

    named = docs.select("doc_id", F.xxhash64("text").alias("body"), "text")
    return map_rows(named, ["doc_id", "body", "text"], "doc_id long, body long, fp long", make)


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have both bit i and bit j set."""
    schema = "cell int, n long"

    def count(batches):
        total = np.zeros((BITS + 1, BITS), np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total[:BITS] += (bits.T.astype(np.float32) @ bits.astype(np.float32)).astype(np.int64)
            total[BITS, 0] += len(values)
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["cell", "n"]
        )

    # One row for each pair of bits, however many fingerprints there are.
    found = nodes.select("fp").mapInArrow(tidy(count), schema).groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros((BITS + 1) * BITS, np.int64)
    for cell, n in found:
        flat[cell] = n
    total = flat.reshape(BITS + 1, BITS)
    return int(total[BITS, 0]), total[:BITS]


def correlated_parts(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of about equal size, correlated bits together."""
    share = both / max(n, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    close = np.abs(share - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(close, 0.0)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        size = math.ceil(len(free) / (parts - k))
        group = [max(free, key=lambda b: (close[b, free].sum(), -b))]
        while len(group) < size:
            rest = [b for b in free if b not in group]
            group.append(max(rest, key=lambda b: (close[b, group].sum(), -b)))
        free = [b for b in free if b not in group]
        groups.append(sorted(group))
    return groups


def within(chances: np.ndarray, limit: int) -> float:
    """Probability that at most ``limit`` of independent events happen."""
    exact = np.zeros(limit + 1)
    exact[0] = 1.0
    for q in chances:
        exact[1:] = exact[1:] * (1 - q) + exact[:-1] * q
        exact[0] *= 1 - q
    return float(exact.sum())


def allocate(costs: list[list[float]], max_bits: int) -> tuple[float, list[int]]:
    """Thresholds of least cost; ``costs[i][t + 1]`` is that of threshold t in partition i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (spent, chosen) in best.items():
            for units in range(max_bits + 2 - used):
                option = (spent + cost[units], [*chosen, units - 1])
                if used + units not in after or option < after[used + units]:
                    after[used + units] = option
        best = after
    return best[max_bits + 1]


def plan_search(n: int, both: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Partitions to search, as (bit mask, threshold)."""
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    choices = []
    for parts in range(1, max_bits + 3):
        groups = correlated_parts(n, both, parts)
        costs = [
            [0.0] + [
                n * sum(math.comb(len(g), k) for k in range(t + 1))
                + n * (n - 1) / 2 * within(differ[g], t)
                for t in range(max_bits + 1)
            ]
            for g in groups
        ]
        cost, thresholds = allocate(costs, max_bits)
        choices.append((cost, parts, [
            (sum(1 << b for b in g), t) for g, t in zip(groups, thresholds) if t >= 0
        ]))
    return min(choices)[2]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _flips(bits: list[int], most: int) -> list[int]:
    """All bit patterns with at most ``most`` of these bits set."""
    return [
        _signed(sum(1 << b for b in chosen))
        for k in range(most + 1) for chosen in combinations(bits, k)
    ]


def _filed(nodes: DataFrame, part: int, mask: int, flips: list[int]) -> DataFrame:
    value = F.col("fp").bitwiseAND(F.lit(_signed(mask)))
    if flips == [0]:
        return nodes.select(F.lit(part).alias("part"), value.alias("value"), "fp")
    flip = F.explode(F.array([F.lit(f) for f in flips])).alias("flip")
    return nodes.select("fp", value.alias("at"), flip).select(
        F.lit(part).alias("part"), F.col("at").bitwiseXOR(F.col("flip")).alias("value"), "fp"
    )


def _close(a: Column, b: Column, max_bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


def links(nodes: DataFrame, max_bits: int, bucket: int) -> DataFrame:
    """Links ``u, v`` that connect all ``fp`` at ``max_bits`` or fewer differing bits."""
    n, both = bit_counts(nodes)
    search = plan_search(n, both, max_bits)
    bits_of = [[b for b in range(BITS) if mask >> b & 1] for mask, _ in search]
    index = reduce(DataFrame.union, [_filed(nodes, k, m, [0]) for k, (m, _) in enumerate(search)])
    probes = reduce(DataFrame.union, [
        _filed(nodes, k, m, _flips(bits_of[k], t)) for k, (m, t) in enumerate(search)
    ])
    crowded = stored(
        index.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket)
        .select("part", "value"),
        "crowded",
    )
    thin, dense = probes, None
    if not crowded.isEmpty():
        thin = probes.join(crowded, ["part", "value"], "left_anti")
        dense = probes.join(crowded, ["part", "value"], "left_semi").select("fp").distinct()
    a, b = thin.alias("a"), index.alias("b")
    found = a.join(
        b,
        (F.col("a.part") == F.col("b.part")) & (F.col("a.value") == F.col("b.value"))
        & (F.col("a.fp") != F.col("b.fp")) & _close(F.col("a.fp"), F.col("b.fp"), max_bits),
    ).select(
        F.greatest("a.fp", "b.fp").alias("u"), F.least("a.fp", "b.fp").alias("v")
    ).distinct()
    if dense is None:
        return found
    flip = F.explode(F.array([F.lit(f) for f in _flips(list(range(BITS)), max_bits // 2)]))
    named = dense.select("fp", flip.alias("flip")).select(
        F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), "fp"
    )
    least = named.groupBy("point").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n"))
    shared = named.join(least.filter("n > 1"), "point").filter(F.col("fp") > F.col("v"))
    return found.union(shared.select(F.col("fp").alias("u"), "v").distinct())


def _grouped(docs: DataFrame, settings: SimHashSettings) -> DataFrame:
    """``doc_id, body, fp, root, component_id`` of every row; ``root`` names the group in any case."""
    prints = stored(fingerprints(docs, settings.shingle), "simhash")
    nodes = stored(
        prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "simhash-nodes"
    )
    roots = components(links(nodes, settings.max_bits, settings.bucket))
    linked = roots.join(nodes, roots["node"] == nodes["fp"]).select("fp", "root", "first")
    names = linked.groupBy("root").agg(F.min("first").alias("name"))
    named = linked.join(names, "root").select("fp", "root", "name")
    labels = stored(nodes.join(named, "fp", "left").select(
        "fp", "n", F.coalesce("root", "fp").alias("root"), F.coalesce("name", "first").alias("component_id")
    ), "simhash-labels")
    # Rows of a common fingerprint take its label where they are; the others are few to a key.
    total = nodes.agg(F.sum("n")).first()[0] or 0
    common = F.col("n") * HEAVY_SHARE > total
    heavy = F.broadcast(labels.filter(common).drop("n"))
    near = prints.join(heavy, "fp", "left")
    rare = near.filter(F.col("root").isNull()).select("fp", "doc_id", "body").join(
        labels.filter(~common).drop("n"), "fp"
    )
    out = ["doc_id", "body", "fp", "root", "component_id"]
    return near.filter(F.col("root").isNotNull()).select(*out).unionByName(rare.select(*out))


def simhash_groups(docs: DataFrame, settings: SimHashSettings = SimHashSettings()) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``doc_id, text``."""
    return _grouped(docs, settings).select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one_of_each_group(docs: DataFrame, settings: SimHashSettings = SimHashSettings()) -> DataFrame:
    """One row of each group, with all its columns: that with the smallest ``doc_id``.

    Rows are told apart by id and text, so texts that share an id without being near
    copies all stay; of a group's texts under its smallest id that with the least hash
    stays. Repeated rows stay once. Rows without a ``doc_id`` cannot be named; they stay.
    """
    docs, back = set_aside(docs)
    rows = stored(_grouped(docs, settings).filter("doc_id is not null"), "simhash-groups")
    best = rows.groupBy("root").agg(F.min(F.struct("doc_id", "body")).alias("best"))
    best = best.select(F.col("best.doc_id").alias("__id"), F.col("best.body").alias("__body"))
    kept = rows.select(F.col("doc_id").alias("__id"), F.col("body").alias("__body")).distinct()
    gone = kept.join(best, ["__id", "__body"], "left_anti")
    marked = docs.withColumns({"__id": F.col("doc_id"), "__body": F.xxhash64("text")})
    left = marked.join(gone, ["__id", "__body"], "left_anti")
    # Repeated rows of a kept document lie together; rows without an id are spread by their text.
    place = F.row_number().over(Window.partitionBy("__id", "__body").orderBy("__body"))
    once = left.withColumn("__place", place).filter("__id is null or __place = 1")
    return once.select(*docs.columns).withColumnsRenamed(back)
