import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation, functions as F

from blockmill.config import PackSettings, TokenProfile
from blockmill.functions import ByteTokenizer, resolve_pad
from blockmill.operators.filters import exact_length, finite_guard, supervised_batches, token_range_guard
from blockmill.operators.ranks import rank_coverage, rank_shards, step_plan
from blockmill.operators.training import (
    batch_training_arrays, mask_stats, micro_batches, token_extrema, training_rows,
)
from blockmill.plans.build import build, shards_of
from blockmill.plans.reader import read_batches, read_training_rows
from blockmill.session import stored
from blockmill.sources import scan_packed, write_shards
from blockmill.sources.shards import drop_shards
from helpers import specs_for

PAD = 9


def packed(spark, shards, seq_len=4):
    """Rows [shard, block, 0, 0, ...] with the given row count per shard."""
    rows, block = [], 0
    for shard, n in shards.items():
        for _ in range(n):
            rows.append((shard, block, [shard, block % 9] + [0] * (seq_len - 2), "s"))
            block += 1
    return spark.createDataFrame(rows, "shard_id int, block_id long, input_ids array<int>, source string")


def files(spark, ids):
    return spark.createDataFrame([(i, f"shard-{i:06d}.parquet") for i in ids], "shard_id int, file string")


def test_masks_and_labels(spark):
    rows = spark.createDataFrame([([1, PAD, 3],), ([PAD] * 3,)], "input_ids array<int>")
    got = training_rows(rows, PAD).collect()
    assert [tuple(map(list, r)) for r in got] == [
        ([1, PAD, 3], [1, -100, 3], [1, 0, 1]), ([PAD] * 3, [-100] * 3, [0] * 3)]
    assert {t for _, t in training_rows(rows, PAD).dtypes} == {"array<bigint>"}
    kept = training_rows(rows, None).first()
    assert kept["labels"] == [1, PAD, 3] and kept["attention_mask"] == [1, 1, 1]
    stats = mask_stats(training_rows(rows, PAD)).first()
    assert tuple(stats) == (2, 2, 6)
    assert tuple(token_extrema(rows).first()) == (1, PAD)


def test_length_guard_counts_what_it_skips(spark):
    rows = spark.createDataFrame([([1, 2],), ([1],), ([],), (None,), ([3, 4],)], "input_ids array<int>")
    seen = Observation("guard")
    assert exact_length(rows, 2, seen).count() == 2
    assert seen.get == {"rows_read": 5, "rows_skipped": 3}


@pytest.mark.parametrize("ids, low, high", [([0, -1], -1, 0), ([5, 300], 5, 300)])
def test_range_guard_reports_the_extremes(spark, ids, low, high):
    rows = spark.createDataFrame([([1],), (ids,)], "input_ids array<int>")
    with pytest.raises(PySparkException, match=f"min {low}, max {high}"):
        token_range_guard(rows, 300).collect()
    fine = spark.createDataFrame([([0, 299],)], "input_ids array<int>")
    assert token_range_guard(fine, 300).collect()[0][0] == [0, 299]


def test_unsupervised_batches_leave(spark):
    rows = spark.createDataFrame(
        [(0, [[-100, -100], [-100, 4]]), (1, [[-100, -100]])], "batch_id int, labels array<array<bigint>>")
    assert [r["batch_id"] for r in supervised_batches(rows).collect()] == [0]
    ids = spark.createDataFrame(
        [(0, [[PAD, PAD], [PAD, 4]]), (1, [[PAD, PAD]])], "batch_id int, input_ids array<array<int>>")
    assert [r["batch_id"] for r in supervised_batches(ids, "input_ids", PAD).collect()] == [0]
    assert supervised_batches(ids, "input_ids", None).count() == 2


def test_range_guard_on_batches(spark):
    batches = spark.createDataFrame([([[1, 2], [3, 300]],)], "input_ids array<array<int>>")
    with pytest.raises(PySparkException, match="min 1, max 300"):
        token_range_guard(batches, 300).collect()
    assert token_range_guard(batches, 301).count() == 1


def test_pad_fallbacks(spark):
    one = spark.range(1)
    null, eos, vocab = F.lit(None).cast("int"), F.lit(5), F.lit(100)
    for pad, mode, want in ((null, "build", 5), (null, "train", 100), (F.lit(3), "build", 3), (F.lit(3), "train", 3)):
        assert one.select(resolve_pad(pad, eos, vocab, mode)).first()[0] == want
    with pytest.raises(ValueError):
        resolve_pad(null, eos, vocab, "other")


@pytest.mark.parametrize("seed", [None, 7])
@pytest.mark.parametrize("world", [1, 3, 8])
def test_every_shard_has_one_rank(spark, seed, world):
    shards = files(spark, [0, 1, 2, 5, 6, 7, 9000])
    assigned = rank_shards(shards, world, seed)
    assert rank_coverage(shards, assigned).count() == 0
    per_rank = {}
    for r in assigned.orderBy("rank", "shard_pos").collect():
        per_rank.setdefault(r["rank"], []).append(r)
    for rows in per_rank.values():
        assert [r["shard_pos"] for r in rows] == list(range(len(rows)))
    if seed is None:
        assert [r["shard_id"] for r in per_rank[0]] == [0, 1, 2, 5, 6, 7, 9000][::world]


def test_coverage_reports_both_faults(spark):
    shards = files(spark, [0, 1, 2])
    assigned = rank_shards(shards, 1).filter("shard_id < 2")
    twice = assigned.filter("shard_id = 1").withColumn("rank", F.lit(4))
    got = {r["file"]: r["ranks"] for r in rank_coverage(shards, assigned.unionByName(twice)).collect()}
    assert got == {"shard-000001.parquet": 2, "shard-000002.parquet": 0}


def model_batches(shards, world, size):
    """The rows of every rank in order, cut into batches."""
    block, by_shard = 0, {}
    for shard, n in shards.items():
        by_shard[shard] = [[shard, (block + i) % 9, 0, 0] for i in range(n)]
        block += n
    out = {}
    for rank in range(world):
        rows = [r for shard in sorted(shards)[rank::world] for r in by_shard[shard]]
        for i in range(0, len(rows), size):
            out[rank, i // size] = rows[i:i + size]
    return out


@pytest.mark.parametrize("size", [1, 3, 64])
def test_batches_follow_the_row_order(spark, size, monkeypatch):
    monkeypatch.setattr("blockmill.operators.training.SLAB_ROWS", 5)
    monkeypatch.setattr("blockmill.operators.training._SHARDS_PER_PART", 2)
    shards = {0: 7, 1: 1, 2: 30, 3: 4, 6: 9, 7: 2}
    table = packed(spark, shards)
    odd = spark.createDataFrame([(2, 10**6, [1], "s")], table.schema)
    got = micro_batches(table.unionByName(odd), rank_shards(files(spark, shards), 2), size, 4)
    found = {(r["rank"], r["batch_id"]): [list(x) for x in r["input_ids"]] for r in got.collect()}
    assert found == model_batches(shards, 2, size)


def test_batch_arrays(spark):
    batches = spark.createDataFrame([(0, [[1, PAD], [3, 4]])], "batch_id int, input_ids array<array<int>>")
    r = batch_training_arrays(batches, PAD).first()
    assert [list(x) for x in r["labels"]] == [[1, -100], [3, 4]]
    assert [list(x) for x in r["attention_mask"]] == [[1, 0], [1, 1]]
    assert dict(batch_training_arrays(batches, PAD).dtypes)["input_ids"] == "array<array<bigint>>"


def test_no_rows_no_batches(spark):
    none = packed(spark, {0: 1}).filter("false")
    assert micro_batches(none, rank_shards(files(spark, [0]), 2), 2, 4).count() == 0


def test_step_plan_formula(spark):
    lines = spark.createDataFrame([(4096 * 100,), (4096 * 28 + 1,)], "tokens long")
    assert tuple(step_plan(lines, 4096, 4, 4, 1).first()) == (4096 * 128 + 1, 65536, 9)


def test_reader_end_to_end(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("source", "doc_id", "text")
    path = f"{tmp_path}/out"
    plan = build(docs, specs_for({f"src{i}": 1 for i in range(20)}), PackSettings(64, None, 500, 1),
                 ByteTokenizer(), path)
    profile = TokenProfile(257, 256, 256)
    rows = read_training_rows(spark, shards_of(path), 64, profile, world=3, seed=5)
    assert rows.count() == plan.n_blocks
    with pytest.raises(PySparkException, match="out of range"):
        read_batches(spark, shards_of(path), 64, TokenProfile(200, 256, 256), 8).collect()
    bad = rows.filter(
        F.exists(F.arrays_zip("input_ids", "labels", "attention_mask"), lambda t:
                 (t["attention_mask"] != (t["input_ids"] != 256).cast("long"))
                 | (t["labels"] != F.when(t["attention_mask"] == 1, t["input_ids"]).otherwise(-100))))
    assert bad.count() == 0
    batches = read_batches(spark, shards_of(path), 64, profile, 8, world=3, seed=5)
    assert batches.select(F.explode("input_ids")).count() == plan.n_blocks
    sizes = batches.groupBy("rank").agg(F.count_if(F.size("input_ids") < 8).alias("short")).collect()
    assert all(r["short"] <= 1 for r in sizes)


def test_guards_hold_without_their_column(spark):
    """Pruning the guarded column does not remove the guard."""
    rows = spark.createDataFrame([([1, 999], "a"), ([2, 3], "b"), (None, "c")], "input_ids array<int>, source string")
    guarded = token_range_guard(rows, 257)
    log = spark.createDataFrame([(1, 1, 0.5), (2, 2, float("nan"))], "opt_step long, micro_step long, loss double")
    for failing, match in (
        (lambda: guarded.count(), "out of range"),
        (lambda: guarded.groupBy("source").count().collect(), "out of range"),
        (lambda: finite_guard(log).count(), "not finite at opt_step 2"),
        (lambda: finite_guard(log).select("opt_step").collect(), "not finite"),
    ):
        with pytest.raises(PySparkException, match=match):
            failing()
    assert token_range_guard(rows, 1000).count() == 3
    assert finite_guard(log.filter("opt_step = 1")).count() == 1


def test_readers_follow_the_manifest_and_report_lengths(spark, tmp_path):
    path = f"{tmp_path}/out"
    docs = spark.createDataFrame([("s", d, "x" * 50) for d in range(200)], "source string, doc_id long, text string")
    plan = build(docs, specs_for({"s": 1}), PackSettings(64, None, 20, 1), ByteTokenizer(), path)
    stray = stored(scan_packed(spark, shards_of(path)).drop("file", "shard_id"), "stray")
    write_shards(stray, shards_of(path), 20, first_shard=500, mode="append")
    profile, manifest = TokenProfile(257, 256, 256), f"{path}/manifest"
    assert read_training_rows(spark, shards_of(path), 64, profile, manifest=False).count() == 2 * plan.n_blocks
    assert read_training_rows(spark, shards_of(path), 64, profile).count() == plan.n_blocks
    assert read_training_rows(spark, shards_of(path), 64, profile, manifest=manifest).count() == plan.n_blocks
    batches = read_batches(spark, shards_of(path), 64, profile, 8, manifest=manifest)
    assert batches.select(F.explode("input_ids")).count() == plan.n_blocks
    drop_shards(spark, shards_of(path), 500)
    for settings in ((8, 3, 2), (5, 2, None)):
        with_lines, without = (
            sorted((r["rank"], r["batch_id"], r["input_ids"]) for r in read_batches(
                spark, shards_of(path), 64, profile, *settings, manifest=m).collect()) for m in (manifest, False))
        assert with_lines == without
    write_shards(stray, shards_of(path), 20, first_shard=500, mode="append")
    seen = Observation("lengths")
    assert read_training_rows(spark, shards_of(path), 32, profile, manifest=False, observation=seen).count() == 0
    assert seen.get == {"rows_read": 2 * plan.n_blocks, "rows_skipped": 2 * plan.n_blocks}
