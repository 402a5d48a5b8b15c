"""Shards made visible by commits, and digests read in pieces."""

import glob
import hashlib
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from blockmill.config import PackSettings, TokenProfile
from blockmill.plans.reader import read_batches, read_training_rows
from blockmill.sources import append_manifest, audit_manifest, shard_files, write_shards
from blockmill.sources import files as files_module
from blockmill.sources.files import digests, file_sha256, split_address
from blockmill.sources.published import (
    audit_published, commit, committed_lists, publish_shards, published_manifest, scan_published, sweep,
    write_attempt,
)

LEN, PER_SHARD = 8, 5


@pytest.fixture()
def blocks(spark):
    ids = F.transform(F.sequence(F.lit(0), F.lit(LEN - 1)), lambda k: (F.col("id") * 7 + k).cast("int"))
    return spark.range(0, 53, 1, 4).select(
        F.col("id").alias("block_id"), ids.alias("input_ids"), F.concat(F.lit("s"), F.col("id") % 3).alias("source")
    )


def rows_of(frame):
    return sorted((r["block_id"], r["input_ids"], r["source"], r["shard_id"]) for r in frame.collect())


def wanted(blocks, label=lambda s: s):
    return sorted(
        (r["block_id"], r["input_ids"], label(r["source"]), r["block_id"] // PER_SHARD) for r in blocks.collect()
    )


def test_published_rows_and_lines(spark, blocks, tmp_path):
    path = f"{tmp_path}/out"
    assert publish_shards(blocks, path, PER_SHARD, in_folder=4) == 0
    assert rows_of(scan_published(spark, path)) == wanted(blocks)
    lines = {r["shard_id"]: r for r in published_manifest(spark, path).collect()}
    assert sorted(lines) == list(range(11))
    for shard, line in lines.items():
        assert line["path"].startswith(f"shards/group={shard // 4}/")
        with open(f"{path}/{line['path']}", "rb") as file:
            assert line["sha256"] == hashlib.sha256(file.read()).hexdigest()
        held = pq.ParquetFile(f"{path}/{line['path']}").read()
        assert held.num_rows == line["rows"] == (PER_SHARD if shard < 10 else 3)
        assert line["tokens"] == line["rows"] * LEN
        assert held["block_id"].to_pylist() == sorted(held["block_id"].to_pylist())
    assert not glob.glob(f"{path}/**/_temporary", recursive=True)


def test_only_commits_count(spark, blocks, tmp_path):
    path = f"{tmp_path}/out"
    with pytest.raises(FileNotFoundError):
        scan_published(spark, path)
    lists = write_attempt(blocks.withColumn("source", F.lit("lost")), path, PER_SHARD)
    assert lists and published_manifest(spark, path).count() == 0
    publish_shards(blocks.filter("block_id < 20"), path, PER_SHARD)
    assert publish_shards(
        blocks.filter("block_id >= 20"), path, PER_SHARD, first_block=20, first_shard=4) == 1
    # A torn shard, a torn list and a torn commit of a lost driver.
    for name in ("shards/group=0/shard-000003-x.parquet", "lists/x.json", "commits/000000002.json"):
        with open(f"{path}/{name}", "w") as file:
            file.write('{"version": 2, "lists": ["x"')
    assert rows_of(scan_published(spark, path)) == wanted(blocks)
    assert set(r["verdict"] for r in audit_published(spark, path).collect()) == {"ok"}
    assert sweep(spark, path) == 11 + 1
    assert sweep(spark, path) == 0
    assert rows_of(scan_published(spark, path)) == wanted(blocks)


def test_a_shard_published_again_replaces_the_older(spark, blocks, tmp_path):
    path = f"{tmp_path}/out"
    publish_shards(blocks, path, PER_SHARD)
    publish_shards(blocks.filter("block_id < 10").withColumn("source", F.lit("new")), path, PER_SHARD)
    want = [(b, i, "new" if b < 10 else s, n) for b, i, s, n in wanted(blocks)]
    assert rows_of(scan_published(spark, path)) == want
    assert published_manifest(spark, path).count() == 11


def test_training_reads_what_is_committed(spark, blocks, tmp_path):
    path, plain = f"{tmp_path}/out", f"{tmp_path}/plain"
    publish_shards(blocks, path, PER_SHARD)
    write_attempt(blocks.withColumn("input_ids", F.reverse("input_ids")), path, PER_SHARD)
    write_shards(blocks, plain, PER_SHARD)
    profile = TokenProfile(1 << 20, None, None)
    for size, world, seed in ((4, 2, None), (5, 1, 7)):
        got, want = (
            sorted((r["rank"], r["batch_id"], r["input_ids"]) for r in
                   read_batches(spark, p, LEN, profile, size, world, seed).collect())
            for p in (path, plain)
        )
        assert got == want and got
        got, want = (
            sorted((r["rank"], r["shard_pos"], r["block_id"], r["labels"]) for r in
                   read_training_rows(spark, p, LEN, profile, world, seed).collect())
            for p in (path, plain)
        )
        assert got == want and len(got) == 53


def test_two_commits_of_one_version_cannot_both_hold(spark, blocks, tmp_path, monkeypatch):
    from blockmill.sources import published

    path = f"{tmp_path}/out"
    publish_shards(blocks, path, PER_SHARD)
    lists = write_attempt(blocks.withColumn("source", F.lit("late")), path, PER_SHARD)
    monkeypatch.setattr(published, "folder_names", lambda spark, folder: [])  # has not seen the other yet
    with pytest.raises(FileExistsError):
        commit(spark, path, lists)
    monkeypatch.undo()
    assert rows_of(scan_published(spark, path)) == wanted(blocks)
    assert len(committed_lists(spark, path)) >= 1


def test_nothing_to_publish(spark, blocks, tmp_path):
    assert write_attempt(blocks.limit(0), f"{tmp_path}/out", PER_SHARD) == []
    commit(spark, f"{tmp_path}/out", [])
    assert published_manifest(spark, f"{tmp_path}/out").count() == 0


def test_audit_finds_damage(spark, blocks, tmp_path):
    path = f"{tmp_path}/out"
    publish_shards(blocks, path, PER_SHARD)
    places = {r["shard_id"]: f"{path}/{r['path']}" for r in published_manifest(spark, path).collect()}
    os.truncate(places[3], os.path.getsize(places[3]) - 1)
    with open(places[7], "ab") as file:
        file.write(b"x")
    os.remove(places[9])
    for name in glob.glob(f"{path}/shards/**/.*.crc", recursive=True):
        os.remove(name)
    found = {r["shard_id"]: r["verdict"] for r in audit_published(spark, path).collect()}
    assert found == {n: "other content" if n in (3, 7) else "no file" if n == 9 else "ok" for n in range(11)}


def test_addresses():
    assert split_address("/a/b=1/c") == ("file", "", "/a/b=1/c")
    assert split_address("file:/a/b") == ("file", "", "/a/b")
    assert split_address("file:///a/b c%20") == ("file", "", "/a/b c%20")
    assert split_address("s3a://bucket/a=1/b") == ("s3a", "bucket", "/a=1/b")
    assert split_address("relative/a:b") == ("file", "", "relative/a:b")
    assert not files_module.reachable("abfss://x@y/z")


@pytest.mark.parametrize("size", [0, 1, 1023, 1024, 5000])
def test_digest_in_pieces(tmp_path, size):
    data = os.urandom(size)
    (tmp_path / "f").write_bytes(data)
    for piece in (1, 1024, 1 << 20):
        assert file_sha256(f"{tmp_path}/f", piece) == hashlib.sha256(data).hexdigest()


def test_shards_are_listed_without_whole_files(spark, blocks, tmp_path, monkeypatch):
    """Spark's reader of whole files refuses them here; digests come from pieces."""
    path = f"{tmp_path}/shards"
    write_shards(blocks, path, PER_SHARD)
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 10)
    try:
        append_manifest(spark, path, f"{tmp_path}/manifest", LEN)
        verdicts = audit_manifest(spark, path, f"{tmp_path}/manifest", LEN).collect()
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)
    assert len(verdicts) == 11 and {r["verdict"] for r in verdicts} == {"ok"}
    for r in verdicts:
        place = glob.glob(f"{path}/shard_id={int(r['file'][6:12])}/*.parquet")[0]
        with open(place, "rb") as file:
            assert r["sha256"] == hashlib.sha256(file.read()).hexdigest()
    assert shard_files(spark, path).count() == 11


def test_stores_that_tasks_cannot_open(spark, blocks, tmp_path, monkeypatch):
    write_shards(blocks, f"{tmp_path}/shards", PER_SHARD)
    pieces = {r["path"]: r["sha256"] for r in digests(spark, f"{tmp_path}/shards").collect()}
    monkeypatch.setattr(files_module, "reachable", lambda address: False)
    assert {r["path"]: r["sha256"] for r in digests(spark, f"{tmp_path}/shards").collect()} == pieces


def test_shards_may_be_of_any_size():
    assert PackSettings(seq_len=1 << 20, blocks_per_shard=1 << 12).blocks_per_shard == 1 << 12
