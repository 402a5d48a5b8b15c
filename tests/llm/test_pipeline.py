"""The pipeline against brute force, and every query of the subpackage on the smallest tables."""

import hashlib
from collections import Counter

import duckdb
import psutil
import pytest
import tiktoken

import corpus_pipeline as P
from blockmill.llm import bpe, queries as Q
from blockmill.llm.texts import tidy
from llm_cases import comparable
from test_quality_rules import brute as quality
from test_simhash import groups, slow_print
from test_substring_dedup import brute as repeats


def test_each_stage_on_the_rows_before(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    first = sorted(map(tuple, docs.collect()))
    found = {}
    for name, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, small), "test")
        found[name] = docs
        if name != "bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    def rows(name):
        return sorted(map(tuple, found[name].collect()))

    good = rows("quality_rules")
    assert good == [r for r in first if not quality(r[1])[5]]

    roots = groups([slow_print(r[1]) for r in good])
    assert rows("simhash") == [r for k, r in enumerate(good) if roots[k] == k]

    cut = {r[0]: r for r in rows("substring_dedup")}
    assert len(cut) == found["simhash"].count()
    for doc_id, _, removed, digest in repeats(rows("simhash"), 50):
        text = cut[doc_id][1]
        assert hashlib.sha256(b" ".join(text.encode().split())).hexdigest() == digest
        assert cut[doc_id][4] == len(text)

    mixed = rows("mixing")
    assert set(mixed) <= set(cut.values()) and max(Counter(mixed).values()) <= Q.MIX_EPOCHS
    total = sum(len(r[1].encode()) for r in cut.values())
    assert 0.9 * total < sum(len(r[1].encode()) for r in mixed) <= total + 20 * 40_000

    settings = bpe.default_settings()
    library = tiktoken.Encoding(
        "own", pat_str=settings.pattern, mergeable_ranks=bpe.read_ranks(settings.rank_file), special_tokens={})
    want = [(r[0], library.encode_ordinary(r[1])) for r in mixed]
    assert comparable((r["doc_id"], r["ids"]) for r in found["bpe"].collect()) == comparable(want)
    assert comparable(P.run(spark, small).collect()) == comparable(found["bpe"].collect())


def test_stages_of_an_empty_table(spark, small, nothing):
    docs = nothing
    for _, stage in P.STAGES:
        docs = stage(spark, docs, small)
        assert docs.count() == 0


TABLES = {"op7_warc": "pages", "op8_html_extraction": "pages", "op11_whitening": "embeddings"}


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_queries_run(spark, small, name):
    got = Q.QUERIES[name](spark, small)
    table = TABLES.get(name, "documents")
    n = spark.read.parquet(f"{small}/{table}.parquet").count() * (4 if name == "op11_whitening" else 1)
    assert got.count() == n or name == "op1_mixing"
    if name in Q.ORACLE:
        con = duckdb.connect()
        con.execute(f"create view documents as select * from '{small}/documents.parquet'")
        result = con.execute(Q.ORACLE[name])
        names = [c[0] for c in result.description]
        assert sorted(names) == sorted(got.columns)
        assert comparable(got.select(*names).collect()) == comparable(result.fetchall())


def test_the_contract_registers_all():
    import __spark_entry__ as contract

    numbers = {n.split("_")[0] for n in contract.queries() if n.startswith("op")}
    assert numbers == {f"op{k}" for k in range(1, 14)} and "pipeline" in contract.queries()


def test_a_worker_gives_back_what_a_task_has_freed():
    """Blocks below the last one in use stay with the allocator unless it is told."""
    held = []

    def task(batches):
        blocks = [bytes(100_000) for _ in range(2000)]
        held.append(bytes(100_000))
        yield from batches
        assert len(blocks) == 2000

    process = psutil.Process()
    before = process.memory_info().rss
    assert list(tidy(task)([1, 2])) == [1, 2]
    assert process.memory_info().rss - before < 50e6
