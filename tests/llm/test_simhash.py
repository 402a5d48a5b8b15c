import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from blockmill.llm import graph, simhash as S
from llm_cases import DOCS, edge_rows, prose


def slow_print(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k: k + size]) for k in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, most=2):
    """Component of each value by comparing all pairs."""
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if bin(values[a] ^ values[b]).count("1") <= most:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [root(k) for k in range(len(values))]


def test_groups_equal_all_pairs(edges):
    rows = edge_rows()
    prints = [slow_print(r[1]) for r in rows]
    roots = groups(prints)
    least = {}
    for row, root in zip(rows, roots):
        if row[0] is not None:
            least[root] = min(least.get(root, row[0]), row[0])
    want = sorted(((r[0], p, least.get(k)) for r, p, k in zip(rows, prints, roots)), key=repr)
    got = S.simhash_groups(edges)
    found = sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got.collect()), key=repr)
    assert found == want


def near_values(n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(8)]
    out = set()
    while len(out) < n:
        value = rng.choice(centres)
        for _ in range(rng.randint(0, 5)):
            value ^= 1 << rng.randrange(64)
        out.add(value)
    return sorted(out)


def test_links_connect_all_pairs_whatever_the_bucket(spark):
    values = near_values(300, 5)
    want = groups(values)
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    for bucket in (1, 10, 100_000):
        roots = dict(map(tuple, graph.components(S.links(nodes, 2, bucket)).collect()))
        found = {}
        for v in values:
            signed = v - (1 << 64) if v >> 63 else v
            found.setdefault(roots.get(signed, signed), []).append(v)
        expected = {}
        for v, k in zip(values, want):
            expected.setdefault(k, []).append(v)
        assert sorted(found.values()) == sorted(expected.values())


def test_thresholds_follow_the_pigeonhole():
    both = np.full((64, 64), 250.0)
    np.fill_diagonal(both, 500)
    for n in (10, 10_000, 10**9, 10**12):
        search = S.plan_search(n, both * n / 1000, 2)
        assert sum(t + 1 for _, t in search) == 3
        masks = [m for m, _ in search]
        assert all(a & b == 0 for k, a in enumerate(masks) for b in masks[:k])
    # With very many fingerprints unequal thresholds on wider partitions are cheaper.
    assert sorted(t for _, t in S.plan_search(10**12, both * 10**9, 2)) != [0, 0, 0]
    assert S.allocate([[0, 5, 6, 7], [0, 1, 9, 9], [0, 1, 1.5, 9]], 2) == (2.5, [-1, 0, 1])


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 40] = bits[:, 3]
    bits[:, 41] = bits[:, 3]
    parts = S.correlated_parts(4000, (bits.T @ bits).astype(float), 4)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert any({3, 40, 41} <= set(p) for p in parts)


def test_components_of_long_chains(spark):
    links = [(k, k + 1) for k in range(0, 400)] + [(1000, 1003), (1003, 1000), (7, 7), (2000, 2000)]
    random.Random(1).shuffle(links)
    found = dict(map(tuple, graph.components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert found == {**{k: 0 for k in range(401)}, 1000: 1000, 1003: 1000}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_stage_keeps_one_of_each_group(spark, edges, nothing):
    kept = S.keep_one_of_each_group(edges)
    assert kept.columns == edges.columns
    ids = [r["doc_id"] for r in kept.collect()]
    names = {r["component_id"] for r in S.simhash_groups(edges).filter("doc_id is not null").collect()}
    assert sorted(i for i in ids if i is not None) == sorted(names)
    assert ids.count(None) == 2
    assert S.keep_one_of_each_group(nothing).count() == 0 and S.simhash_groups(nothing).count() == 0
    copies = spark.createDataFrame([(k, prose(1, 50), "en", "s", 1) for k in range(50)], DOCS)
    assert [r["doc_id"] for r in S.keep_one_of_each_group(copies).collect()] == [0]


def test_texts_that_share_an_id_stay(spark):
    """Rows are named by id and text; only near copies go."""
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(1, a, "en", "s", 1), (1, b, "en", "t", 1), (2, c, "en", "s", 1), (3, a, "en", "u", 1), (1, a, "en", "s", 1)]
    frame = spark.createDataFrame(rows, DOCS)
    names = "__place __id __body own__place root body fp".split()
    frame = frame.withColumns({n: F.col("source") for n in names})
    kept = S.keep_one_of_each_group(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"], r["text"], r["__place"], r["own__place"]) for r in kept.collect()) == sorted(
        [(1, a, "s", "s"), (1, b, "t", "t"), (2, c, "s", "s")])


def test_common_fingerprints_take_their_label_in_place(spark, monkeypatch):
    rows = [(k, prose(k if k % 3 else 0, 40), "en", "s", 1) for k in range(60)] + [(None, prose(0, 40), "en", "s", 1)]
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    want = sorted(map(tuple, S.simhash_groups(frame).collect()), key=repr)
    for share in (0, 4, 1 << 40):
        monkeypatch.setattr(S, "HEAVY_SHARE", share)
        assert sorted(map(tuple, S.simhash_groups(frame).collect()), key=repr) == want
