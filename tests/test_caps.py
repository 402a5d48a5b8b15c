"""Cuts of many capped sources in few jobs."""

import random

import pytest
from pyspark.sql import functions as F

import model
from blockmill.config import PackSettings
from blockmill.functions import ByteTokenizer
from blockmill.plans import caps as C, mix
from blockmill.plans.build import plan_documents
from blockmill.plans.pack import pack
from helpers import blocks_of, specs_for, table, tail_of

TOK = ByteTokenizer()


def corpus(seed, n_sources, most=120):
    rng = random.Random(seed)
    return {
        f"s{k:03d}": [(d, "x" * rng.choice([0, 3, 9, 20, 64, 65, 200])) for d in range(rng.randint(3, most))]
        for k in range(n_sources)
    }


def plan_and_check(spark, records, caps, seq_len, total, seed, weights=None):
    weights = weights or {s: 1.0 + k % 3 for k, s in enumerate(records)}
    settings = PackSettings(seq_len, total, 16, seed)
    rows, plan = plan_documents(table(spark, records), specs_for(weights, caps), settings, TOK)
    want, _, carry = model.build(records, weights, caps, seq_len, total, seed)
    assert plan.n_blocks == len(want)
    assert blocks_of(pack(rows, plan, TOK)) == want and tail_of(rows, plan, TOK) == carry
    return plan


def count_calls(monkeypatch, *names):
    calls = []
    for name in names:
        def watch(*args, real=getattr(mix, name), name=name):
            calls.append(name)
            return real(*args)
        monkeypatch.setattr(mix, name, watch)
    return calls


@pytest.mark.parametrize("sigmas", [C.SIGMAS, 0.0])
@pytest.mark.parametrize("seed, total", [(1, None), (2, 6000), (3, None), (4, 40_000)])
def test_windows_and_stretches_equal_the_rules(spark, monkeypatch, seed, total, sigmas):
    """Narrow windows leave stretches between them, and stop the walk where they are missed."""
    monkeypatch.setattr(mix, "SIGMAS", sigmas)
    monkeypatch.setattr(mix, "BUCKETS_PER_SLAB", 400)
    records = corpus(seed, 9)
    rng = random.Random(seed)
    caps = {s: rng.choice([50, 400, 900, 2500, 10**6]) for s in list(records)[::2]}
    plan = plan_and_check(spark, records, caps, 32, total, seed)
    assert sum(x.cut is not None for x in plan.lanes) >= 2


def test_two_hundred_caps_take_as_many_jobs_as_five(spark, monkeypatch):
    calls = count_calls(monkeypatch, "next_cuts", "next_cut")
    sc = spark.sparkContext
    records = corpus(7, 210, 40)
    settings = PackSettings(16, None, 16, 7)
    specs = {s: 1.0 for s in records}
    jobs = {}
    for n in (5, 200):
        caps = {s: 300 for s in list(records)[:n]}
        docs = table(spark, records).coalesce(2)
        sc.setJobGroup(f"caps-{n}", "")
        plan_documents(docs, specs_for(specs, caps), settings, TOK)
        jobs[n] = len(sc.statusTracker().getJobIdsForGroup(f"caps-{n}"))
    sc.setJobGroup("", "")
    assert calls == ["next_cuts"] * 2 and jobs[200] <= jobs[5] + 2
    plan = plan_and_check(spark, records, {s: 300 for s in list(records)[:200]}, 16, None, 7, specs)
    assert sum(x.cut is not None for x in plan.lanes) > 100


@pytest.mark.parametrize("seq_len", [1, 5, 8, 13])
def test_block_functions(spark, seq_len):
    """Completed blocks of a stretch for every offset at which it may begin."""
    rng = random.Random(seq_len)
    docs = [(k // 12, rng.choice("abc"), float(k), 0, k, rng.randint(1, 30)) for k in range(60)]
    rows = spark.createDataFrame(
        [(b, s, a, e, d, n, n, 0 if b < 3 else 2) for b, s, a, e, d, n in docs],
        "bucket int, source string, arrival double, epoch int, doc_id long, n_tok long, len long, segment int")
    found = C._block_functions(rows, ["a", "b"], seq_len).collect()
    for segment, part in ((0, docs[:36]), (2, docs[36:])):
        mine = [r for r in found if r["segment"] == segment]
        assert sum(r["delta"] for r in mine if r["at"] == -2) == sum(d[5] for d in part)
        for offset in range(seq_len):
            done, at = {"a": 0, "b": 0, "c": 0}, offset
            for _, s, _, _, _, n in part:
                done[s] += (at + n) // seq_len - at // seq_len
                at += n
            for s in "ab":
                assert sum(r["delta"] for r in mine if r["source"] == s and -2 < r["at"] <= offset) == done[s]
        assert not [r for r in mine if r["source"] == "c"]


def test_windows_hold_few_documents(spark):
    n = 60_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("source"),
        (F.col("id") / n).alias("arrival"), F.lit(0).alias("epoch"), F.col("id").alias("doc_id"),
        (F.pmod(F.xxhash64("id"), F.lit(90)) + 1).alias("n_tok"),
    ).withColumn("len", F.col("n_tok")).withColumn("bucket", F.floor(F.col("arrival") * 4000).cast("int")).persist()
    caps = {"a": 3000, "b": 9000}
    windows = C.cut_windows(rows, caps, 64, C.SIGMAS)
    inside = F.lit(False)
    for first, last, sure in windows.values():
        assert sure
        inside = inside | F.col("bucket").between(first, last)
    assert rows.filter(inside).count() < 0.2 * n
    cuts, all_found = C.next_cuts(rows, caps, 64, None)
    assert all_found and [c[0] for c in cuts] == ["a", "b"]
    off, done, gone = 0, {"a": 0, "b": 0}, {}
    for r in rows.orderBy("arrival", "source").collect():
        if r["source"] in gone:
            continue
        k = (off + r["len"]) // 64 - off // 64
        off += r["len"]
        if r["source"] in done:
            done[r["source"]] += k
            if k and done[r["source"]] >= caps[r["source"]]:
                gone[r["source"]] = r["doc_id"]
    assert {c[0]: c[3] for c in cuts} == gone
    rows.unpersist()
