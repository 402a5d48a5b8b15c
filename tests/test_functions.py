import datetime
import hashlib
import importlib
import random

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from blockmill.config import PackSettings
from blockmill.functions import (
    ByteTokenizer, FileTokenizer, append_eos, block_slice, ids_digest, shard_name, to_long_ids, unit_hash,
)
from blockmill.operators.blocks import assemble_blocks, completed_blocks, document_fragments, mix_report
from blockmill.operators.filters import every_n, finite_guard, nonempty_ids, not_finite, valid_text
from blockmill.operators.mixing import seeded_shuffle
from blockmill.operators.prefix import running_start, unit_bucket
from blockmill.operators import vocabulary
from blockmill.operators.progress import progress_rates
from blockmill.functions.tokenizers import JoinedWordTokenizer
from blockmill.operators.prefix import MAX_BUCKETS, unit_bucket
from blockmill.operators.vocabulary import build_vocab, word_tokenizer
from blockmill.session import stored
from blockmill.plans.build import pack_documents, plan_documents
from blockmill.plans.pack import pack, packed_spans
from blockmill.sources import source_specs
import model
from helpers import blocks_of, specs_for, table, tail_of

NAN, INF = float("nan"), float("inf")


def test_unit_hash_equals_the_model(spark):
    rows = spark.createDataFrame([("src1", 0, 5), ("é", 3, -9)], "s string, e int, d long")
    got = rows.withColumn("u", unit_hash(77, F.col("s"), F.col("e"), F.col("d"))).collect()
    for r in got:
        assert r["u"] == model.unit(77, r["s"], r["e"], r["d"]) and 0 <= r["u"] < 1


def test_byte_tokens(spark):
    text = "aé漢\x00 \n"
    rows = spark.createDataFrame([(text,)], "text string")
    assert rows.select(ByteTokenizer().encode(F.col("text"))).first()[0] == list(text.encode())


def test_small_functions(spark):
    one = spark.createDataFrame([([1, 2, 3, 4, 5],)], "ids array<int>")
    r = one.select(
        append_eos(F.col("ids"), 7).alias("eos"), append_eos(F.col("ids"), None).alias("none"),
        block_slice(F.col("ids"), F.lit(6), F.lit(2), 4).alias("cut"),
        to_long_ids(F.col("ids")).alias("long"), shard_name(F.lit(12)).alias("name"),
        ids_digest(F.col("ids")).alias("digest")).first()
    assert r["eos"] == [1, 2, 3, 4, 5, 7] and r["none"] == [1, 2, 3, 4, 5]
    assert r["cut"] == [3, 4, 5] and r["name"] == "shard-000012.parquet" and len(r["digest"]) == 32


def test_filters(spark):
    rows = spark.createDataFrame([("a",), ("",), (None,), (" ",)], "text string")
    assert [r[0] for r in valid_text(rows).collect()] == ["a", " "]
    ids = spark.createDataFrame([([],), ([1],)], "ids array<int>")
    assert nonempty_ids(ids).count() == 1


def test_finite_guard(spark):
    log = spark.createDataFrame([(1, 8, 0.5), (2, 16, NAN), (3, 24, -INF)], "opt_step int, micro_step int, loss double")
    assert [r["opt_step"] for r in log.filter(not_finite(F.col("loss"))).collect()] == [2, 3]
    with pytest.raises(PySparkException, match="opt_step 2, micro_step 16"):
        finite_guard(log.filter("opt_step < 3")).collect()
    assert finite_guard(log.filter("opt_step < 2")).count() == 1
    assert [r["opt_step"] for r in every_n(log, 2).collect()] == [2]


def test_prefix_sum_equals_one_window(spark):
    rows = spark.range(5000).select(
        "id", F.rand(3).alias("u"), (F.col("id") % 17).alias("v"))
    got = running_start(rows.withColumn("b", unit_bucket(F.col("u"), 37)), "b", ["u", "id"], F.col("v"), "s")
    total = 0
    for r in sorted(got.collect(), key=lambda r: (r["u"], r["id"])):
        assert r["s"] == total
        total += r["v"]


def test_shuffle_is_a_permutation_of_every_source(spark):
    docs = table(spark, {"a": [(d, "x") for d in range(500)], "b": [(d, "x") for d in range(3)]})
    rows = seeded_shuffle(docs, 3).collect()
    by = {s: sorted((r["pos"], r["doc_id"]) for r in rows if r["source"] == s) for s in "ab"}
    for s, n in (("a", 500), ("b", 3)):
        assert [p for p, _ in by[s]] == list(range(n))
        assert [d for _, d in by[s]] == sorted(range(n), key=lambda d: model.unit(3, s, 0, d))


def test_completed_blocks_stop_at_the_limit(spark):
    rows = spark.createDataFrame([(0, 9), (9, 30), (39, 100)], "off long, len long")
    k = rows.select(completed_blocks(F.col("off"), F.col("len"), 10, 5).alias("k")).collect()
    assert [r["k"] for r in k] == [0, 3, 2]


def test_fragments_assemble_to_blocks(spark):
    rows = spark.createDataFrame(
        [("a", 0, [1, 2, 3]), ("b", 3, [4, 5, 6, 7, 8, 9, 10]), ("c", 10, [11, 12, 13])],
        "source string, off long, ids array<int>").withColumn("len", F.size("ids").cast("long"))
    blocks = assemble_blocks(document_fragments(rows, 5), 5).orderBy("block_id").collect()
    assert [(list(r["input_ids"]), r["source"], r["n_docs"]) for r in blocks] == [
        ([1, 2, 3, 4, 5], "b", 2), ([6, 7, 8, 9, 10], "b", 1)]


def test_words_are_ranked_by_count_then_name(spark):
    docs = spark.createDataFrame([("b a  b\n",), ("c\tb a",), ("d",), ("",), (None,)], "text string")
    rows = build_vocab(docs, 3).orderBy("id").collect()
    assert [(r["word"], r["count"], r["id"]) for r in rows] == [("b", 3, 1), ("a", 2, 2), ("c", 1, 3)]
    with pytest.raises(ValueError):
        build_vocab(docs, 0)


def sequential(rows, plan, seq_len, eos):
    """Blocks from the ids of the spans in stream order."""
    ids = {(r["source"], r["doc_id"]): list(r["payload"]) for r in rows.collect()}
    stream, ends = [], []
    for r in packed_spans(rows, plan).orderBy("off").collect():
        stream += ids[r["source"], r["doc_id"]] + ([] if eos is None else [eos])
        ends.append((len(stream), r["source"]))
    blocks = []
    for b in range(len(stream) // seq_len):
        label = next(s for end, s in ends if end >= (b + 1) * seq_len)
        blocks.append((stream[b * seq_len:(b + 1) * seq_len], label))
    return blocks, stream[len(stream) // seq_len * seq_len:]


@pytest.mark.parametrize("eos", [True, False])
def test_word_tokens_pack(spark, eos):
    texts = ["the cat  sat", " on ", "\t", None, "", "the the the mat zebra", "a\nb\rc"]
    docs = table(spark, {"x": list(enumerate(texts * 3)), "y": [(9, "only one")]})
    tok = word_tokenizer(build_vocab(docs, 8), eos)
    encoded = {r["doc_id"]: list(r["payload"]) for r in tok.tokenize(docs).filter("source = 'x'").collect()}
    vocab = {r["word"]: r["id"] for r in build_vocab(docs, 8).collect()}
    for d, t in enumerate(texts):
        assert encoded[d] == [vocab.get(w, 0) for w in (t or "").split()]
    rows, plan = plan_documents(docs, specs_for({"x": 1.0, "y": 1.0}), PackSettings(4, None, 4, 1), tok)
    want, rest = sequential(rows, plan, 4, tok.eos_id)
    assert blocks_of(pack(rows, plan, tok)) == want
    assert tail_of(rows, plan, tok) == rest


@pytest.fixture(scope="module")
def bpe_file():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_bpe_file_packs(spark, small, bpe_file):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("source", "doc_id", "text")
    tok = FileTokenizer.load(spark, bpe_file, "<|endoftext|>")
    assert tok.eos_id == 50256 and tok.vocab_size == 50257
    direct = Tokenizer.from_file(bpe_file)
    rows, plan = plan_documents(docs, specs_for({f"src{i}": 1 for i in range(20)}), PackSettings(128), tok)
    got = {r["doc_id"]: list(r["payload"]) for r in rows.collect()}
    for r in docs.limit(20).collect():
        assert got[r["doc_id"]] == direct.encode(r["text"], add_special_tokens=False).ids
    want, _ = sequential(rows, plan, 128, 50256)
    assert blocks_of(pack(rows, plan, tok)) == want
    with pytest.raises(ValueError):
        FileTokenizer.load(spark, bpe_file, "<|nothing|>")


def test_python_tokens_are_written_once(spark, small, bpe_file):
    """Planning and packing read the table of tokens, not the tokenizer."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("source", "doc_id", "text")
    tok = FileTokenizer.load(spark, bpe_file, "<|endoftext|>")
    blocks = pack_documents(docs, specs_for({f"src{i}": 1 for i in range(20)}), PackSettings(128), tok)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mix_report_shares(spark):
    blocks = spark.createDataFrame([("a",), ("a",), ("b",)], "source string")
    spans = spark.createDataFrame([("a", 10), ("a", 5), ("b", 5)], "source string, len long")
    specs = specs_for({"a": 3.0, "b": 1.0, "c": 0.0}, {"a": 16})
    rows = {r["source"]: r for r in mix_report(blocks, spans, source_specs(spark, specs), 4).collect()}
    assert rows["a"]["label_tokens"] == 8 and rows["a"]["cap_use"] == 0.5 and rows["a"]["wanted_share"] == 0.75
    assert rows["a"]["token_share"] == 0.75 and rows["a"]["doc_share"] == 2 / 3
    assert rows["c"]["label_tokens"] == 0 and rows["c"]["cap_use"] is None


@pytest.mark.parametrize("per_part", [4, 1 << 17])
def test_progress_rates(spark, per_part, monkeypatch):
    monkeypatch.setattr("blockmill.operators.progress._STEPS_PER_PART", per_part)
    lines = [("r", i, i * i, 10 * i, i * 80) for i in range(1, 12)] + [("q", 5, 3, 1, 8), ("q", 9, 3, 30, 48)]
    log = spark.createDataFrame(
        [(run, step * 10, ts, micro) for run, step, _, ts, micro in lines],
        "run string, opt_step long, s long, micro_step long").withColumn("ts", F.timestamp_seconds("s"))
    rows = {(r["run"], r["opt_step"]): r for r in progress_rates(log, 100, 1000, 10).collect()}
    assert rows["r", 10]["tok_per_sec"] is None and rows["q", 50]["dt"] is None
    for i in range(2, 12):
        r = rows["r", i * 10]
        assert r["tokens"] == 8000 and r["dt"] == 10.0 and r["tok_per_sec"] == 800.0
        assert r["eta_hours"] == (1000 - i * 10) * (10.0 / 10.0) / 3600.0
    assert rows["q", 90]["tok_per_sec"] == 4000 / 29.0


def test_vocabulary_keeps_the_most_frequent_words(spark):
    """Cutting by count classes first changes nothing in the ranking."""
    rng = random.Random(1)
    words = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(20000)]
    docs = spark.createDataFrame([(" ".join(words[i::50]),) for i in range(50)], "text string")
    count = {}
    for w in words:
        count[w] = count.get(w, 0) + 1
    ranked = sorted(count, key=lambda w: (-count[w], w))
    for size in (1, 7, 150, 5000):
        rows = build_vocab(docs, size).orderBy("id").collect()
        assert [(r["word"], r["count"], r["id"]) for r in rows] == [
            (w, count[w], i + 1) for i, w in enumerate(ranked[:size])]


def test_every_word_can_be_kept(spark):
    """More words than the published vocabulary has, ranked and encoded by a join."""
    n = 130_000
    docs = spark.range(n).select(
        F.lit("s").alias("source"), F.col("id").alias("doc_id"),
        F.concat(F.lit("w"), "id", F.lit(" common w"), F.col("id") % 7).alias("text"))
    vocab = stored(build_vocab(docs, None), "vocab")
    assert vocab.agg(F.count("*"), F.min("id"), F.max("id"), F.countDistinct("id")).first() == (n + 1, 1, n + 1, n + 1)
    words = [r["word"] for r in vocab.orderBy("id").collect()]
    count = {"common": n} | {f"w{k}": 1 + (k < 7) * len(range(k, n, 7)) for k in range(n)}
    assert words == sorted(words, key=lambda w: (-count[w], w))
    tok = JoinedWordTokenizer(vocab, n + 1)
    number = {w: k + 1 for k, w in enumerate(words)}
    few = docs.filter("doc_id % 9973 = 0").union(docs.filter("doc_id = 0")).union(
        spark.createDataFrame([("s", 5, None), ("s", 6, ""), ("s", None, "common no-such-word")],
                              "source string, doc_id long, text string"))
    for r in tok.tokenize(few).collect():
        if r["doc_id"] in (5, 6):
            want = []
        elif r["doc_id"] is None:
            want = [number["common"], 0]
        else:
            want = [number[w] for w in (f"w{r['doc_id']}", "common", f"w{r['doc_id'] % 7}")]
        assert list(r["payload"]) == want and r["n_tok"] == len(want)
    assert tok.tokenize(few).count() == few.count()


def test_bucket_numbers_are_not_clamped():
    with pytest.raises(ValueError, match="buckets"):
        unit_bucket(F.lit(0.5), MAX_BUCKETS + 1)


@pytest.mark.parametrize("per_part", [1 << 17, 40])
def test_rates_from_the_start_of_a_run(spark, per_part, monkeypatch):
    monkeypatch.setattr("blockmill.operators.progress._SECONDS_PER_PART", per_part)
    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    # Run r begins at 0, logs at 10 and 30, stands still, begins anew at 500 and logs at 520; q has no start.
    log = spark.createDataFrame(
        [("r", at(10), 10, 40), ("r", at(30), 20, 80), ("r", at(520), 30, 120), ("q", at(7), 5, 9), (None, at(1), 1, 1)],
        "run string, ts timestamp, opt_step long, micro_step long")
    starts = spark.createDataFrame([("r", at(0), None), ("r", at(500), 80), ("x", at(3), None)],
                                   "run string, ts timestamp, micro_step long")
    rows = {(r["run"], r["opt_step"]): r for r in progress_rates(log, 100, 1000, 10, starts=starts).collect()}
    assert set(rows) == {("r", 10), ("r", 20), ("r", 30), ("q", 5)}
    assert [(rows["r", k]["tokens"], rows["r", k]["dt"]) for k in (10, 20, 30)] == [(4000, 10.0), (4000, 20.0), (4000, 20.0)]
    assert rows["r", 10]["tok_per_sec"] == 400.0 and rows["q", 5]["tok_per_sec"] is None
    plain = progress_rates(log, 100, 1000, 10, starts=starts.drop("micro_step"))
    assert {r["tokens"] for r in plain.filter("opt_step = 30").collect()} == {12_000}
    assert plain.columns == progress_rates(log, 100, 1000, 10).columns


def largest_over_median(df, part):
    sizes = sorted(r["count"] for r in df.groupBy(part).count().collect())
    return sizes[-1] / sizes[len(sizes) // 2]


def test_ranges_and_joins_of_a_zipf_vocabulary_are_even(spark, monkeypatch):
    """Words that begin alike, most of them seen once, and a few that make up the text."""
    n = 60_000
    docs = spark.range(n).select(
        F.lit("s").alias("source"), F.col("id").alias("doc_id"),
        F.concat(F.lit("http"), "id", F.lit(" the the of http"), F.col("id") % 50).alias("text"))
    seen = []
    monkeypatch.setattr(vocabulary, "_WORDS_PER_RANGE", 4000)
    monkeypatch.setattr(vocabulary, "stored", lambda df, name, real=vocabulary.stored: seen.append((name, real(df, name))) or seen[-1][1])
    vocab = stored(build_vocab(docs, None), "vocab")
    ranges = dict(seen)["word-ranges"]
    assert ranges.select("range").distinct().count() >= 10 and largest_over_median(ranges, "range") <= 3
    words = [r["word"] for r in vocab.orderBy("id").collect()]
    count = {"the": 2 * n, "of": n} | {f"http{k}": 1 + (k < 50) * (n // 50) for k in range(n)}
    assert words == sorted(words, key=lambda w: (-count[w], w)) and len(words) == n + 2
    monkeypatch.setattr(JoinedWordTokenizer, "HEAVY", 40)
    tok = JoinedWordTokenizer(vocab, n + 2)
    # What is left for the shuffle, the rare words, is as good as even over any number of parts.
    heavy = set(words[:40])
    rare = docs.select(F.explode(F.split("text", " ")).alias("w")).filter(~F.col("w").isin(*heavy))
    assert largest_over_median(rare.withColumn("p", F.pmod(F.hash("w"), F.lit(16))), "p") <= 3
    number = {w: k + 1 for k, w in enumerate(words)}
    rows = tok.tokenize(docs.filter("doc_id % 3001 = 0")).collect()
    assert len(rows) == 20
    for r in rows:
        k = r["doc_id"]
        assert list(r["payload"]) == [number[w] for w in (f"http{k}", "the", "the", "of", f"http{k % 50}")]


def test_words_are_looked_up_in_bounded_parts(monkeypatch):
    tokenizers = importlib.import_module("blockmill.functions.tokenizers")
    texts = pa.array([" a b ", "", "c" * 50, "x  a", *["b a"] * 30])
    words = pa.array(["a", "b"], pa.large_string())
    whole = tokenizers._word_ids(texts, words).to_pylist()
    assert whole[:4] == [[1, 2], [], [0], [0, 1]]
    monkeypatch.setattr(tokenizers, "_TEXT_AT_ONCE", 20)
    parts = list(tokenizers._text_slices(texts))
    assert max(len("".join(p.to_pylist())) for p in parts if len(p) > 1) <= 20 and len(parts) > 4
    assert pa.concat_arrays([tokenizers._word_ids(p, words) for p in parts]).to_pylist() == whole
    assert [len(p) for p in tokenizers._text_slices(texts.slice(0, 0))] == [0]


def test_digest_joins_ids_without_a_string_of_each(spark):
    rows = [[1, 2, 300], [], [0], [-1, 5], [7, None, 8], [None], [None, None, 10], None, [2**31 - 1, -2**31]]
    for kind in ("int", "long"):
        got = spark.createDataFrame([(k, ids) for k, ids in enumerate(rows)], f"k int, ids array<{kind}>").select(
            "k", ids_digest(F.col("ids")).alias("digest"))
        want = [ids if ids is None else hashlib.md5(",".join(str(i) for i in ids if i is not None).encode()).hexdigest()
                for ids in rows]
        assert [r["digest"] for r in got.orderBy("k").collect()] == want
        assert "to_json(" in got._jdf.queryExecution().analyzed().toString()
