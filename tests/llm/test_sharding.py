import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, strategies as st

from blockmill.llm import sharding as H
from llm_cases import DOCS, edge_rows, prose


def plain_best_fit(sizes, capacity):
    left, out = [], [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(r, s) for s, r in enumerate(left) if r >= sizes[k]]
        if not fits:
            left.append(capacity)
            fits = [(capacity, len(left) - 1)]
        _, shard = min(fits)
        left[shard] -= sizes[k]
        out[k] = shard
    return out


@given(st.lists(st.integers(1, 50), max_size=80))
def test_tree_places_like_a_list(sizes):
    assert H.best_fit_decreasing(sizes, 60) == plain_best_fit(sizes, 60)


def test_tree_stays_right_under_removal():
    rng, tree, keys = random.Random(2), H.CapacityTree(), set()
    for step in range(3000):
        if keys and rng.random() < 0.45:
            key = rng.choice(sorted(keys))
            keys.remove(key)
            tree.remove(key)
        else:
            key = (rng.randint(0, 60), step)
            keys.add(key)
            tree.insert(key)
        size = rng.randint(0, 70)
        assert tree.tightest(size) == min((k for k in keys if k[0] >= size), default=None)


def test_limits():
    assert H.best_fit_decreasing([5], 4) is None and H.best_fit_decreasing([3, 3], 3, 1) is None
    assert H.tight_shards([], 3) == (0, []) and H.tight_shards([7], 3) == (7, [0])
    sizes = [4, 3, 3, 2, 2, 2]
    enough = next(c for c in range(8, 20) if max(plain_best_fit(sizes, c)) < 2)
    assert H.tight_shards(sizes, 2) == (enough, plain_best_fit(sizes, enough))


def check(rows, got, n_shards):
    texts = defaultdict(list)
    for doc_id, text, *_ in rows:
        texts[doc_id].append(text)
    slots, sizes = defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    found = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert found == want
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(n_shards))
    return sizes


def test_edge_rows(edges, nothing):
    check(edge_rows(), H.assign_shards(edges, H.ShardSettings(4, 32)).collect(), 4)
    assert H.assign_shards(nothing).count() == 0


def test_equal_sizes_and_whole_groups(spark):
    rows = [(k, prose(k % 900, 20 + k % 60), "en", "s", 0) for k in range(2000)]
    rows += [(5000 + k, prose(77, 200), "en", "s", 0) for k in range(900)]  # more than a shard holds
    got = H.assign_shards(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    sizes = check(rows, got, 16)
    assert len(sizes) == 16 and max(sizes.values()) <= 1.02 * min(sizes.values())
    where, text_of = defaultdict(set), {r[0]: r[1] for r in rows}
    for r in got:
        where[text_of[r["doc_id"]]].add(r["shard"])
    assert sorted(len(s) for s in where.values())[-2] == 1
    again = H.assign_shards(spark.createDataFrame(rows[::-1], DOCS).repartition(3)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_settings():
    with pytest.raises(ValueError):
        H.ShardSettings(0)


@pytest.mark.parametrize("shared", [None, 7])
def test_equal_texts_without_ids_of_their_own(spark, shared):
    """A large group whose rows have no id, or all the same one, is dealt as evenly as any."""
    rows = [(shared, prose(77, 30), "en", "s", 0) for _ in range(4000)]
    rows += [(100 + k, prose(k, 30), "en", "s", 0) for k in range(1200)]
    frame = spark.createDataFrame(rows, DOCS)
    got = H.assign_shards(frame.repartition(5)).collect()
    sizes = check(rows, got, 16)
    assert len(sizes) == 16 and max(sizes.values()) <= 1.05 * min(sizes.values())
    again = H.assign_shards(frame.repartition(2)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
