import importlib
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import model
from catalog.queries import run_stream
from blockmill.functions import ByteTokenizer
from blockmill.operators.vocabulary import build_vocab, word_tokenizer
from blockmill.session import plain_renames
from blockmill.sources import stream_packed, write_shards
from blockmill.streaming import ProgressLog, observed, pack_stream, plan_lanes
from helpers import table

pack_stream_module = importlib.import_module("blockmill.streaming.pack_stream")
TOK = ByteTokenizer()
LEN, LANES = 64, 3


def start(spark, source, out, state, fail_after=None, tok=None):
    stream = spark.readStream.schema("source string, doc_id long, text string").option(
        "maxFilesPerTrigger", 1).parquet(source)
    blocks = observed(pack_stream(stream, tok or TOK, LEN, LANES, 5))

    def sink(batch, number):
        if fail_after is not None and number >= fail_after:
            raise RuntimeError("stopped for the test")
        batch.write.mode("overwrite").parquet(f"{out}/trigger={number}")

    return (blocks.writeStream.option("checkpointLocation", state).foreachBatch(sink)
            .trigger(availableNow=True).start())


@pytest.fixture()
def source(spark, tmp_path):
    records = {
        "hot": [(d, "h" * (d % 90)) for d in range(200)],
        "cold": [(d, "c" * 70) for d in range(10)],
    }
    docs = table(spark, records)
    for part in range(4):
        docs.filter(F.col("doc_id") % 4 == part).coalesce(1).write.parquet(f"{tmp_path}/in/part={part}")
    return f"{tmp_path}/in/*", records


def expected(records):
    tokens = {}
    for s, docs in records.items():
        for d, t in docs:
            if t:
                lane = s, int(model.unit(5, s, d) * LANES)
                tokens[lane] = tokens.get(lane, 0) + len(t) + 1
    return {lane: n // LEN for lane, n in tokens.items() if n >= LEN}


def found(spark, out):
    rows = spark.read.parquet(out).collect()
    lanes = {}
    for r in rows:
        assert len(r["input_ids"]) == LEN
        lanes.setdefault((r["source"], r["lane"]), []).append(r["seq"])
    for seqs in lanes.values():
        assert sorted(seqs) == list(range(len(seqs)))
    return {lane: len(s) for lane, s in lanes.items()}, rows


def test_stream_packs_and_resumes(spark, source, tmp_path):
    path, records = source
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    with pytest.raises(Exception, match="stopped for the test"):
        start(spark, path, out, state, fail_after=2).awaitTermination()
    before, _ = found(spark, out)
    assert sum(before.values()) < sum(expected(records).values())
    start(spark, path, out, state).awaitTermination()
    counts, rows = found(spark, out)
    assert counts == expected(records)
    # Every packed token of the hot source is one of its bytes or an end mark.
    assert {i for r in rows if r["source"] == "hot" for i in r["input_ids"]} <= {ord("h"), 256}


def test_words_stream_too(spark, tmp_path):
    docs = table(spark, {"s": [(d, "one two  three ") for d in range(120)] + [(999, None)]})
    docs.write.parquet(f"{tmp_path}/in")
    tok = word_tokenizer(build_vocab(docs, None))
    start(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state", tok=tok).awaitTermination()
    _, rows = found(spark, f"{tmp_path}/out")
    ids = {i: 0 for i in range(5)}
    for r in rows:
        for i in r["input_ids"]:
            ids[i] += 1
    assert ids[0] == 0 and len({ids[i] // 10 for i in (1, 2, 3, 4)}) <= 2 and tok.eos_id == 4


def test_progress_totals(spark, source, tmp_path):
    path, records = source
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        start(spark, path, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
        want = sum(expected(records).values())
        for _ in range(50):
            if log.blocks >= want:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    assert (log.blocks, log.tokens) == (want, want * LEN) and log.triggers >= 4


def test_shards_stream_in_bounded_steps(spark, tmp_path):
    rows = spark.range(90).select(
        F.col("id").alias("block_id"), F.array(F.col("id").cast("int")).alias("input_ids"), F.lit("s").alias("source"))
    write_shards(rows, f"{tmp_path}/shards", 10)
    query = (stream_packed(spark, f"{tmp_path}/shards", 2).writeStream.format("memory").queryName("shards_seen")
             .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 5
    seen = spark.table("shards_seen").orderBy("block_id").collect()
    assert [(r["block_id"], r["shard_id"]) for r in seen] == [(i, i // 10) for i in range(90)]


def test_progress_of_more_than_a_hundred_triggers(spark, tmp_path):
    docs = table(spark, {"s": [(d, "x" * LEN) for d in range(110)]})
    docs.repartition(110, "doc_id").write.option("maxRecordsPerFile", 1).parquet(f"{tmp_path}/in")
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        query = start(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state")
        query.awaitTermination()
        log.wait_for(query)
    finally:
        spark.streams.removeListener(log)
    assert log.triggers >= 110
    assert (log.blocks, log.tokens) == (sum(n for n in found(spark, f"{tmp_path}/out")[0].values()), log.blocks * LEN)


def test_one_document_a_trigger_gives_the_exact_blocks(spark, tmp_path):
    """What each lane emits is its documents in the order they came, cut at the block length."""
    texts = {d: chr(97 + d % 26) * (20 + 7 * d) for d in range(12)}
    for d, text in texts.items():
        table(spark, {"s": [(d, text)]}).coalesce(1).write.parquet(f"{tmp_path}/in/n={d:02d}")
        time.sleep(0.01)
    start(spark, f"{tmp_path}/in/*", f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    streams = {}
    for d, text in texts.items():
        lane = int(model.unit(5, "s", d) * LANES)
        streams.setdefault(lane, []).extend([*text.encode(), 256])
    got = {(r["lane"], r["seq"]): list(r["input_ids"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {
        (lane, k): ids[k * LEN: (k + 1) * LEN] for lane, ids in streams.items() for k in range(len(ids) // LEN)}


def test_shards_stream_from_a_folder_that_is_still_empty(spark, tmp_path):
    """Begun before the first shard, in a missing folder; both layouts come later."""
    path = f"{tmp_path}/shards"
    query = (stream_packed(spark, path, 2).writeStream.format("memory").queryName("from_nothing")
             .option("checkpointLocation", f"{tmp_path}/state").start())
    try:
        query.processAllAvailable()
        assert spark.table("from_nothing").count() == 0
        rows = spark.range(40).select(
            F.col("id").alias("block_id"), F.array(F.col("id").cast("int")).alias("input_ids"), F.lit("s").alias("source"))
        write_shards(rows, path, 10, mode="append")
        query.processAllAvailable()
        flat = pa.table({"input_ids": pa.array([[7], [8]], pa.list_(pa.int32())), "source": ["f", "f"]})
        pq.write_table(flat, f"{path}/shard-000009.parquet")
        pq.write_table(pa.table({"other": [1]}), f"{path}/notes.parquet")
        query.processAllAvailable()
    finally:
        query.stop()
    seen = spark.table("from_nothing").collect()
    assert sorted((r["shard_id"], r["block_id"], r["input_ids"], r["source"]) for r in seen) == [
        *[(k // 10, k, [k], "s") for k in range(40)], (9, 0, [7], "f"), (9, 1, [8], "f")]


def test_a_stream_lists_many_shards_in_a_few_tasks(spark, tmp_path):
    """No stage has a task for each shard folder, neither when the stream is set up nor when it runs."""
    rows = spark.range(80).select(
        F.col("id").alias("block_id"), F.array(F.col("id").cast("int")).alias("input_ids"), F.lit("s").alias("source"))
    write_shards(rows, f"{tmp_path}/shards", 1)

    def next_stage():
        job = spark.sparkContext._jsc.sc().dagScheduler().nextStageId()
        return int(job)

    first = next_stage()
    found = run_stream(
        spark, stream_packed(spark, f"{tmp_path}/shards", 40), places=(f"{tmp_path}/out", f"{tmp_path}/state"))
    status = spark.sparkContext.statusTracker()
    stages = [s for s in map(status.getStageInfo, range(first, next_stage())) if s]
    assert len(stages) >= 4 and max(s.numTasks for s in stages) <= 40
    assert sorted(r["block_id"] for r in found.collect()) == list(range(80))


def test_a_stream_renames_its_local_logs_without_processes(spark, tmp_path):
    """A checkpoint begun the usual way goes on with plain renames, no shard lost or read twice."""
    path, places = f"{tmp_path}/shards", (f"{tmp_path}/out", f"{tmp_path}/state")
    rows = spark.range(40).select(
        F.col("id").alias("block_id"), F.array(F.col("id").cast("int")).alias("input_ids"), F.lit("s").alias("source"))
    write_shards(rows.filter("block_id < 16"), path, 1)
    usual = (stream_packed(spark, path, 1).writeStream.format("parquet").option("path", places[0])
             .option("checkpointLocation", places[1]).trigger(availableNow=True).start())
    usual.awaitTermination()
    write_shards(rows.filter("block_id >= 16"), path, 1, mode="append")
    managers = []

    class Log(ProgressLog):
        def wait_for(self, query):
            log = query._jsq.streamingQuery().offsetLog()
            managers.append(log.fileManager().getClass().getSimpleName())

    found = run_stream(spark, stream_packed(spark, path, 1), Log(), places)
    assert managers == ["FileSystemBasedCheckpointFileManager"]
    assert sorted(r["block_id"] for r in found.collect()) == list(range(40))
    key = "spark.sql.streaming.checkpointFileManagerClass"
    assert not spark.conf.get(key, None)
    spark.conf.set(key, "set.by.others")
    try:
        with plain_renames(spark, *places):
            assert spark.conf.get(key) == "set.by.others"
        assert spark.conf.get(key) == "set.by.others"
    finally:
        spark.conf.unset(key)


def test_hot_source_gets_more_lanes_and_no_token_is_lost(spark, tmp_path):
    """Every token of the stream is in a block or in what a lane still carries; none twice."""
    def arrive(first, last):
        rows = [("hot", d, f"{d:05d}" * 9) for d in range(first, last)] + [("cold", d, f"{d:05d}" * 2) for d in range(first, last, 9)]
        spark.createDataFrame(rows, "source string, doc_id long, text string").coalesce(1).write.mode("append").parquet(
            f"{tmp_path}/in")

    def run(lanes):
        stream = spark.readStream.schema("source string, doc_id long, text string").parquet(f"{tmp_path}/in")
        query = (pack_stream(stream, TOK, LEN, lanes, 5).writeStream.format("parquet").option("path", f"{tmp_path}/out")
                 .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start())
        query.awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out")

    arrive(0, 300)
    blocks = run(2)
    before = {"hot": 2, "cold": 2}
    lanes = plan_lanes(blocks.groupBy("source").agg(F.sum(F.size("input_ids")).alias("tokens")), 12, before)
    assert lanes["hot"] >= 10 and lanes["cold"] >= 2
    arrive(300, 900)
    blocks = run(lanes).collect()
    want, carried = {}, {}
    for d in range(900):
        for source, text in [("hot", f"{d:05d}" * 9)] + ([("cold", f"{d:05d}" * 2)] if (d if d < 300 else d - 300) % 9 == 0 else []):
            n = (before if d < 300 else lanes)[source]
            lane = source, int(model.unit(5, source, d) * n)
            want.setdefault(lane, []).append(text)
    for lane, texts in want.items():
        rows = sorted((r["seq"], r["input_ids"]) for r in blocks if (r["source"], r["lane"]) == lane)
        total = sum(len(t) + 1 for t in texts)
        assert [seq for seq, _ in rows] == list(range(total // LEN))
        stream = [i for _, ids in rows for i in ids]
        carried[lane] = total - len(stream)
        whole = "".join(chr(i) if i < 256 else "\n" for i in stream).split("\n")
        assert len(set(whole[:-1])) == len(whole[:-1]) and set(whole[:-1]) <= set(texts)
    assert len({lane for s, lane in want if s == "hot"}) == lanes["hot"]
    assert all(0 <= n < LEN for n in carried.values()) and len(blocks) == sum(
        sum(len(t) + 1 for t in texts) // LEN for texts in want.values())


def test_lanes_follow_volume(spark):
    tokens = spark.createDataFrame([("a", 600), ("b", 300), ("b", 0), ("c", 100), ("d", None), (None, 5)], "source string, tokens long")
    assert plan_lanes(tokens, 100) == {"a": 60, "b": 30, "c": 10, "d": 1}
    assert plan_lanes(tokens, 10, {"c": 7, "gone": 3}) == {"a": 6, "b": 3, "c": 7, "d": 1, "gone": 3}
    assert plan_lanes(tokens.limit(0), 10) == {}
    with pytest.raises(ValueError):
        plan_lanes(tokens, 0)


def test_a_lane_holds_few_ids_at_a_time(monkeypatch):
    """Long and many documents come out in frames of bounded size, with every id in its place."""
    monkeypatch.setattr(pack_stream_module, "TOKENS_AT_ONCE", 1000)

    class State:
        exists, kept = True, None
        get = ([7, 7, 7], 5)

        def update(self, value):
            self.kept = value

    texts = [b"a" * 9_000, b"", b"bc" * 40, *[b"d" * 130] * 100]
    state, end = State(), np.asarray([256], np.int32)
    batches = iter([pd.DataFrame({"payload": texts[:2]}), pd.DataFrame({"payload": texts[2:]})])
    frames = list(pack_stream_module._filled(("s", 0), batches, state, TOK.reader(), end, LEN))
    assert max(len(f) * LEN for f in frames) <= 2 * 1000 + LEN
    blocks = pd.concat(frames)
    want = [7, 7, 7, *[i for t in texts for i in [*t, 256]]]
    assert [*np.frombuffer(b"".join(blocks["raw"]), np.int32)] + state.kept[0] == want
    assert list(blocks["seq"]) == list(range(5, 5 + len(want) // LEN)) and state.kept[1] == 5 + len(want) // LEN
