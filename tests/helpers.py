from pyspark.sql import functions as F, types as T

from blockmill.config import SourceSpec
from blockmill.plans.pack import pack

DOCS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
])


def table(spark, records):
    rows = [(s, d, t) for s, docs in records.items() for d, t in docs]
    return spark.createDataFrame(rows, DOCS)


def specs_for(weights, caps=None):
    caps = caps or {}
    return [SourceSpec(s, s, None, "text", float(w), caps.get(s)) for s, w in weights.items()]


def blocks_of(df):
    rows = df.select("block_id", "input_ids", "source").orderBy("block_id").collect()
    assert [r["block_id"] for r in rows] == list(range(len(rows)))
    return [(list(r["input_ids"]), r["source"]) for r in rows]


def tail_of(rows, plan, tok, first_block=0):
    """The unpacked tokens, taken from a pack that returns them as a last row."""
    packed = pack(rows, plan, tok, first_block, with_tail=True)
    found = packed.filter(F.col("block_id") == plan.n_blocks).collect()
    assert len(found) <= 1
    return list(found[0]["input_ids"]) if found else []
