import blockmill.plans.mix as mix
from blockmill.config import PackSettings
from blockmill.functions import ByteTokenizer
from blockmill.operators.mixing import stream_offsets
from blockmill.operators.prefix import bucket_starts
from blockmill.plans.build import plan_documents
from helpers import specs_for
from pyspark.sql import functions as F


def test_rounds_neither_shuffle_nor_sort_the_documents(spark, small, monkeypatch):
    """Each round reads the kept rows as they lie; only bucket sums move."""
    seen = []
    original = mix.next_cuts

    def watch(rows, *settings):
        placed = stream_offsets(rows, starts=bucket_starts(rows, "bucket", F.col("len")))
        out = placed.groupBy("source").agg(F.sum("off"))
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        top = plan.split("InMemoryTableScan")[0]
        window = top[top.index("Window [sum(len"):]
        seen.append("Sort" not in window and "Exchange" not in window.replace("BroadcastExchange", ""))
        return original(rows, *settings)

    monkeypatch.setattr(mix, "next_cuts", watch)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("source", "doc_id", "text")
    specs = specs_for({f"src{i}": 1 for i in range(20)}, {"src1": 3000, "src2": 5000})
    plan_documents(docs, specs, PackSettings(64, None, 64, 1), ByteTokenizer())
    # One round settles both caps.
    assert seen == [True]
