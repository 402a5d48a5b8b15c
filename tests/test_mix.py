import random

import pytest
from hypothesis import HealthCheck, given, settings as hyp, strategies as st

import model
from blockmill.config import PackSettings
from blockmill.functions import ByteTokenizer
from blockmill.operators import mixing
from blockmill.plans import mix
from blockmill.plans.build import pack_documents, plan_documents
from blockmill.plans.pack import pack, packed_spans
from helpers import blocks_of, specs_for, table, tail_of

TOK = ByteTokenizer()


def check(spark, records, weights, caps, seq_len, total, seed, eos=True):
    """The Spark build equals the sequential one: blocks, documents and left-over."""
    tok = ByteTokenizer(eos)
    settings = PackSettings(seq_len, total, 4, seed)
    rows, plan = plan_documents(table(spark, records), specs_for(weights, caps), settings, tok)
    want, used, carry = model.build(records, weights, caps, seq_len, total, seed, eos)
    assert plan.n_blocks == len(want)
    assert blocks_of(pack(rows, plan, tok)) == want
    assert tail_of(rows, plan, tok) == carry
    spans = packed_spans(rows, plan).orderBy("off").collect()
    assert [(r["source"], r["epoch"], r["doc_id"]) for r in spans] == used
    return plan


words = st.text(alphabet="ab é漢", max_size=40)
lanes = st.lists(words, min_size=1, max_size=8).filter(any)


@hyp(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    texts=st.lists(lanes, min_size=1, max_size=3),
    weights=st.lists(st.sampled_from([0.01, 0.5, 1.0, 3.0]), min_size=3, max_size=3),
    caps=st.lists(st.sampled_from([None, 1, 20, 60, 200]), min_size=3, max_size=3),
    seq_len=st.sampled_from([1, 7, 16]),
    total=st.sampled_from([None, 1, 100, 333]),
    seed=st.integers(0, 99),
)
def test_equals_sequential_build(spark, texts, weights, caps, seq_len, total, seed):
    records = {f"s{i}": list(enumerate(t)) for i, t in enumerate(texts)}
    names = list(records)
    check(
        spark, records, dict(zip(names, weights)),
        {s: c for s, c in zip(names, caps) if c is not None}, seq_len, total, seed,
    )


def test_caps_renormalise_and_sources_repeat(spark):
    rng = random.Random(5)
    records = {
        s: [(d, "x" * rng.randint(0, 90)) for d in range(n)]
        for s, n in {"big": 60, "mid": 25, "tiny": 3}.items()
    }
    plan = check(
        spark, records, {"big": 0.8, "mid": 0.15, "tiny": 0.05},
        {"mid": 500, "tiny": 160}, 32, 9000, 11,
    )
    assert {x.name for x in plan.lanes if x.cut} == {"mid", "tiny"}
    assert max(x.epochs for x in plan.lanes) > 2


def test_a_tiny_source_repeated_very_often(spark, monkeypatch):
    monkeypatch.setattr("blockmill.plans.mix.MANY_EPOCHS", 3)
    records = {
        "big": [(d, "b" * 30) for d in range(200)],
        "tiny": [(d, "t" * (5 + d)) for d in range(3)],
        "some": [(d, "s" * 9) for d in range(120)],
    }
    plan = check(spark, records, {"big": 1.0, "tiny": 1.0, "some": 1.0}, {"some": 600}, 32, 12000, 6)
    assert max(x.epochs for x in plan.lanes) > 40


def test_packing_from_a_later_block(spark):
    records = {s: [(d, s * 25) for d in range(40)] for s in ("a", "b")}
    rows, plan = plan_documents(
        table(spark, records), specs_for({"a": 1.0, "b": 2.0}), PackSettings(16, 3000, 4, 3), TOK)
    want = blocks_of(pack(rows, plan, TOK))
    for first in (1, 4, plan.n_blocks - 1, plan.n_blocks):
        rest = pack(rows, plan, TOK, first).orderBy("block_id").collect()
        assert [r["block_id"] for r in rest] == list(range(first, plan.n_blocks))
        assert [(list(r["input_ids"]), r["source"]) for r in rest] == want[first:]
        assert tail_of(rows, plan, TOK, first) == tail_of(rows, plan, TOK)


def test_all_sources_capped_ends_before_the_budget(spark):
    records = {s: [(d, "abc" * 9) for d in range(20)] for s in ("a", "b")}
    plan = check(spark, records, {"a": 1.0, "b": 2.0}, {"a": 100, "b": 150}, 16, 10**6, 3)
    assert plan.n_blocks * 16 < 10**6


def test_a_heavy_capped_source_is_not_read_to_the_horizon(spark):
    records = {
        "slow": [(d, "s" * 50) for d in range(50)],
        "fast": [(d, "f" * 50) for d in range(5)],
    }
    plan = check(spark, records, {"slow": 1.0, "fast": 50.0}, {"fast": 300}, 64, 5000, 1)
    fast = next(x for x in plan.lanes if x.name == "fast")
    slow = next(x for x in plan.lanes if x.name == "slow")
    assert fast.end < slow.end / 10


def test_one_source_holds_most_rows(spark):
    records = {
        "hot": [(d, "h" * (d % 50)) for d in range(900)],
        "cold": [(d, "c" * 30) for d in range(20)],
    }
    check(spark, records, {"hot": 1.0, "cold": 1.0}, {}, 128, None, 9)


@pytest.mark.parametrize("eos", [True, False])
def test_edge_rows(spark, eos):
    seq_len = 8
    texts = [None, "", "  ", "a", "b" * (seq_len - 1), "c" * (5 * seq_len), "éèñ漢", "\x00\x7f"]
    records = {"s": list(enumerate(texts))}
    check(spark, records, {"s": 1.0}, {}, seq_len, None, 0, eos)


def test_dropped_records_use_up_their_draw(spark):
    records = {"half": [(d, "" if d % 2 else "y" * 10) for d in range(40)],
               "full": [(d, "z" * 10) for d in range(40)]}
    plan = check(spark, records, {"half": 1.0, "full": 1.0}, {}, 16, None, 2)
    half = next(x for x in plan.lanes if x.name == "half")
    assert (half.n_records, half.n_docs) == (40, 20)


def test_a_document_longer_than_many_tasks(spark):
    records = {"s": [(0, "L" * 50000)] + [(d, "t" * 40) for d in range(1, 50)]}
    check(spark, records, {"s": 1.0}, {}, 64, None, 4)


def test_shared_document_ids_lose_nothing(spark):
    """Ids should be unique; where they are not, every document is still packed once."""
    texts = ["a" * 10, "b" * 10, "c" * 7, "d" * 33] * 10
    docs = table(spark, {"s": [(7, t) for t in texts]})
    blocks = blocks_of(pack_documents(docs, specs_for({"s": 1.0}), PackSettings(4, None, 4, 1), TOK))
    packed = [i for ids, _ in blocks for i in ids]
    stream = sorted(bytes(p).decode() for p in _split(packed))
    assert stream == sorted(texts)


def _split(ids):
    part = []
    for i in ids:
        if i == 256:
            yield part
            part = []
        else:
            part.append(i)


@pytest.mark.parametrize("n", [1, 3, 16])
def test_result_does_not_depend_on_partitions(spark, small, n):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("source", "doc_id", "text")
    specs = specs_for({f"src{i}": 1 + i % 3 for i in range(20)}, {"src3": 4000})
    settings = PackSettings(256, 300_000, 64, 1234)
    want = blocks_of(pack_documents(docs, specs, settings, TOK))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        got = blocks_of(pack_documents(docs.repartition(n), specs, settings, TOK))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == want
    other = PackSettings(256, 300_000, 64, 99)
    assert blocks_of(pack_documents(docs, specs, other, TOK)) != want


def test_smaller_budget_is_a_prefix(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("source", "doc_id", "text")
    specs = specs_for({f"src{i}": 1 + i % 3 for i in range(20)}, {"src5": 3000})
    short, long = [
        blocks_of(pack_documents(docs, specs, PackSettings(128, t, 64, 1), TOK))
        for t in (100_001, 700_000)
    ]
    assert len(short) == -(-100_001 // 128) and len(long) == -(-700_000 // 128)
    assert long[: len(short)] == short


def test_capped_source_stays_below_its_cap_but_for_the_last_document(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("source", "doc_id", "text")
    caps = {"src2": 5000, "src9": 9000}
    specs = specs_for({f"src{i}": 1 for i in range(20)}, caps)
    settings = PackSettings(64, None, 64, 8)
    rows, plan = plan_documents(docs, specs, settings, TOK)
    spans = packed_spans(rows, plan).collect()
    for name, cap in caps.items():
        own = sorted((r["off"], r["len"]) for r in spans if r["source"] == name)
        full = [(o + n) // 64 - o // 64 for o, n in own]
        assert sum(full[:-1]) * 64 < cap <= sum(full) * 64


def test_shares_follow_the_weights(spark):
    weights = {"a": 0.7, "b": 0.2, "c": 0.1}
    records = {s: [(d, "w" * 20) for d in range(4000)] for s in weights}
    rows, plan = plan_documents(
        table(spark, records), specs_for(weights), PackSettings(64, 63_000, 64, 3), TOK)
    drawn = [r["source"] for r in packed_spans(rows, plan).collect()]
    for s, w in weights.items():
        assert abs(drawn.count(s) / len(drawn) - w) < 0.03


def test_epochs_come_one_after_the_other(spark):
    records = {"s": [(d, "e" * 9) for d in range(10)], "t": [(d, "e" * 9) for d in range(30)]}
    rows, plan = plan_documents(
        table(spark, records), specs_for({"s": 1.0, "t": 1.0}), PackSettings(10, 900, 4, 3), TOK)
    for s in records:
        epochs = [r["epoch"] for r in packed_spans(rows, plan).orderBy("off").collect() if r["source"] == s]
        assert epochs == sorted(epochs) and max(epochs) >= 1


def test_buckets_share_the_work(spark):
    """Sources that end early do not crowd the order buckets at the start."""
    records = {
        "quick": [(d, "q" * 20) for d in range(3000)],
        "long": [(d, "l" * 20) for d in range(3000)],
    }
    rows, plan = plan_documents(
        table(spark, records), specs_for({"quick": 1000.0, "long": 1.0}), PackSettings(64), TOK)
    counts = packed_spans(rows, plan).groupBy("bucket").count().collect()
    assert max(r["count"] for r in counts) < 4 * 6000 / plan.n_buckets


def test_useless_sources_are_refused(spark):
    docs = table(spark, {"a": [(0, "x")], "b": [(0, ""), (1, None)]})
    with pytest.raises(ValueError, match="source b has no usable text"):
        plan_documents(docs, specs_for({"a": 1.0, "b": 1.0}), PackSettings(4), TOK)
    rows, plan = plan_documents(docs, specs_for({"a": 1.0, "b": 0.0}), PackSettings(1), TOK)
    assert [x.name for x in plan.lanes] == ["a"] and plan.n_blocks == 2


def test_weighted_choice_bounds(spark):
    specs = specs_for({"a": 1.0, "b": 0.0, "c": 3.0})
    rows = mixing.weighted_choice(spark.range(2000), specs, 7, ["id"]).collect()
    for r in rows[:200]:
        draw = model.unit(7, r["id"]) * 4.0
        assert r["choice"] == ("a" if draw <= 1.0 else "c")
    share = sum(r["choice"] == "a" for r in rows) / len(rows)
    assert abs(share - 0.25) < 0.04


def test_lane_epochs_match_row_arithmetic():
    for end in (0.5, 3.0, 10.0, 10.000001, 33.3):
        lane = mix.Lane("s", 3.0, None, 10, 10, 100, 10, end=end)
        want = sum(1 for e in range(100) if (e + 0.0) * 10 / 3.0 < end)
        assert lane.epochs == max(1, want)


def test_many_sources_share_the_knots_of_the_curve(spark, monkeypatch):
    """More distinct stops than the bucket curve has terms: same blocks."""
    monkeypatch.setattr(mix, "MAX_KNOTS", 5)
    records = {f"s{k:02d}": [(d, "x" * (1 + (7 * d + k) % 50)) for d in range(1 + k)] for k in range(30)}
    weights = {s: 1.0 + i % 4 for i, s in enumerate(records)}
    caps = {s: 32 * (1 + i % 3) for i, s in enumerate(records) if i % 5 == 0}
    specs = specs_for(weights, caps)
    for total in (None, 4000):
        rows, plan = plan_documents(table(spark, records), specs, PackSettings(16, total, 4, 3), TOK)
        want, _, _ = model.build(records, weights, caps, 16, total, 3)
        assert blocks_of(pack(rows, plan, TOK)) == want
