"""What the plans must look like to hold at scale."""

import re

from pyspark.sql import functions as F

from blockmill.config import PackSettings
from blockmill.functions import ByteTokenizer
from blockmill.plans.build import plan_documents
from blockmill.plans.pack import _routes, pack
from blockmill.operators.blocks import per_source_tokens
from blockmill.sources import scan_packed, scan_shard_bytes, write_shards
from catalog.queries import QUERIES, doc_specs, settings
from helpers import specs_for

TOK = ByteTokenizer()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def packed(spark, small, caps=None, total=None):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("source", "doc_id", "text")
    specs = specs_for({f"src{i}": 1 + i % 3 for i in range(20)}, caps)
    rows, plan = plan_documents(docs, specs, PackSettings(128, total, 64, 1), TOK)
    return pack(rows, plan, TOK, whole_shards=True)


def test_packing_shuffles_the_text_once(spark, small):
    text = plan_of(packed(spark, small, {"src3": 3000}, 200_000))
    assert len(re.findall(r"Exchange (?!.*Broadcast)", text)) == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "SortMergeJoin" not in text


def test_unused_columns_are_not_read(spark, small):
    text = plan_of(packed(spark, small))
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in text


def test_writing_adds_no_shuffle_and_one_file_per_shard(spark, small, tmp_path):
    blocks = packed(spark, small)
    write_shards(blocks, f"{tmp_path}/s", 64, clustered=True)
    files = scan_shard_bytes(spark, f"{tmp_path}/s").groupBy("shard_id").count().collect()
    assert {r["count"] for r in files} == {1}


def test_reading_is_pruned(spark, small, tmp_path):
    write_shards(packed(spark, small), f"{tmp_path}/s", 64, clustered=True)
    rows = scan_packed(spark, f"{tmp_path}/s")
    assert "ReadSchema: struct<source:string>" in plan_of(per_source_tokens(rows, 128))
    one = plan_of(rows.filter("shard_id = 3").select("input_ids"))
    assert "PartitionFilters: [isnotnull(shard_id" in one and "ReadSchema: struct<input_ids:array<int>>" in one


def test_no_query_has_a_cross_join(spark, small):
    for name in ("pack_blocks", "mixed_corpus", "mix_report", "micro_batches", "weighted_choice",
                 "stream_offsets", "seeded_shuffle", "progress_rates", "rank_shards"):
        text = plan_of(QUERIES[name](spark, small))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_counting_bytes_needs_no_python(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    text = plan_of(TOK.sizes(docs).agg(F.sum("n_tok")))
    assert "EvalPython" not in text and "ReadSchema: struct<text:string>" in text


def test_the_head_of_a_mix_routes_only_its_buckets(spark, small):
    """Documents of later buckets leave before the shuffle of the text."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("source", "doc_id", "text")
    rows, plan = plan_documents(docs, doc_specs(), settings(), TOK)
    whole, head = pack(rows, plan, TOK), pack(rows, plan, TOK, end_block=plan.n_blocks // 20)
    assert head.count() == plan.n_blocks // 20
    n_all = whole.agg(F.sum("n_docs")).first()[0]
    routed = _routes(plan, spark, 0, plan.n_blocks // 20 - 1, 1).count()
    assert routed < len(plan.buckets) / 10 and head.agg(F.sum("n_docs")).first()[0] < n_all / 10
    assert "Join" in plan_of(QUERIES["head_blocks"](spark, small))
