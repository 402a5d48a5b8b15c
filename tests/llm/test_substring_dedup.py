import hashlib
import random

import numpy as np
import pytest

from blockmill.llm import substring_dedup as R
from llm_cases import DOCS, comparable, edge_rows


def brute(rows, window):
    """(doc_id, words, removed, digest) of each row, by comparing window tuples."""
    split = [((r[0] if r[0] is not None else R.LAST), (r[1] or "").encode().split()) for r in rows]
    first = {}
    for doc, words in split:
        for k in range(len(words) - window + 1):
            key = tuple(words[k: k + window])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, words), row in zip(split, rows):
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if first[tuple(words[k: k + window])] < doc:
                gone[k: k + window] = [True] * window
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((row[0], len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def test_equals_brute_force(edges):
    want = brute(edge_rows(), 50)
    assert sum(w[2] > 0 for w in want) >= 4
    assert comparable(R.removal_digests(edges).collect()) == comparable(want)


@pytest.mark.parametrize("bucket,longest", [(1, 256), (4096, 3)])
def test_small_windows_and_crowded_buckets(spark, bucket, longest):
    rng = random.Random(bucket)
    rows = []
    for doc in range(60):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 40))]
        rows.append((doc, " ".join(words), "en", "s", 0))
    settings = R.RepeatSettings(window=6, mini=3, longest=longest, filter_bits=12, bucket=bucket)
    got = R.removal_digests(spark.createDataFrame(rows, DOCS).repartition(4), settings)
    assert comparable(got.collect()) == comparable(brute(rows, 6))


def test_super_kmers_cover_every_window_once():
    rng = np.random.default_rng(2)
    for n in (0, 49, 50, 51, 500):
        hashes = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        settings = R.RepeatSettings(longest=16)
        _, first, length = R.super_kmers(hashes, settings)
        windows = [k for a, c in zip(first.tolist(), length.tolist()) for k in range(a, a + c)]
        assert windows == list(range(max(0, n - 49))) and (not n or not len(length) or length.max() <= 16)


def test_stage_cuts_the_text(edges, nothing):
    cut = R.remove_repeats(edges)
    assert cut.columns == edges.columns
    texts = {hashlib.sha256(" ".join((r["text"] or "").encode().decode().split(" ")).encode()).hexdigest() for r in cut.collect()}
    assert len(texts) > 3 and cut.count() == len(edge_rows())
    lost = {w[0] for w in brute(edge_rows(), 50) if w[2]}
    before = {r[0]: r[1] for r in edge_rows() if r[0] is not None}
    for row in cut.filter("doc_id is not null").collect():
        assert (row["text"] != before[row["doc_id"]]) == (row["doc_id"] in lost)
    assert R.remove_repeats(nothing).count() == R.removal_digests(nothing).count() == 0


def test_columns_named_like_working_ones(spark, edges):
    names = "__spans __doc __body own__doc".split()
    frame = edges.withColumns({n: edges["source"] for n in names})
    plain, got = R.remove_repeats(edges), R.remove_repeats(frame)
    assert got.columns == frame.columns
    assert comparable(got.select(plain.columns).collect()) == comparable(plain.collect())
    assert got.filter(" or ".join(f"not ({n} <=> source)" for n in names)).count() == 0
