"""Headline timings on one machine; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS
(default 8) the cores. Every query runs once on small tables first, so that
code loading is not measured.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from blockmill.config import PackSettings, TokenProfile  # noqa: E402
from blockmill.functions import ByteTokenizer  # noqa: E402
from blockmill.operators.vocabulary import build_vocab, word_tokenizer  # noqa: E402
from blockmill.plans.build import build, plan_documents, shards_of, tokenized  # noqa: E402
from blockmill.plans.mix import plan_mix  # noqa: E402
from blockmill.plans.pack import pack  # noqa: E402
from blockmill.plans.reader import read_batches, read_training_rows  # noqa: E402
from blockmill.session import scratch_path  # noqa: E402
from blockmill.sources import audit_manifest  # noqa: E402
from catalog.queries import QUERIES, capped_corpus, capped_documents, doc_specs, documents  # noqa: E402

SEQ_LEN, BLOCKS_PER_SHARD, SEED = 4096, 512, 1234
PROFILE = TokenProfile(257, 256, 256)
BYTES = ByteTokenizer()


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def measure(spark: SparkSession, sf_dir: str) -> tuple[dict[str, float], dict[str, int]]:
    seconds: dict[str, float] = {}
    tokens: dict[str, int] = {}

    def timed(name, action):
        begin = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - begin, 3)
        return result

    one_pass = PackSettings(SEQ_LEN, None, BLOCKS_PER_SHARD, SEED)
    docs = documents(spark, sf_dir)
    rows, plan = timed("plan", lambda: plan_documents(docs, doc_specs(), one_pass, BYTES))
    tokens["plan"] = plan.stream_tokens
    timed("pack", lambda: run(pack(rows, plan, BYTES)))
    tokens["pack"] = plan.n_blocks * SEQ_LEN

    path = scratch_path(spark, "bench")
    timed("build", lambda: build(docs, doc_specs(), one_pass, BYTES, path))
    timed("read_rows", lambda: run(read_training_rows(spark, shards_of(path), SEQ_LEN, PROFILE, 4)))
    timed("read_batches", lambda: run(read_batches(
        spark, shards_of(path), SEQ_LEN, PROFILE, 4, 4, SEED, f"{path}/manifest")))
    timed("audit", lambda: run(audit_manifest(spark, shards_of(path), f"{path}/manifest", SEQ_LEN)))
    for name in ("build", "read_rows", "read_batches", "audit"):
        tokens[name] = plan.n_blocks * SEQ_LEN

    def capped():
        capped_docs, specs = capped_documents(spark, sf_dir)
        return plan_documents(capped_docs, specs, one_pass, BYTES)[1]

    def mixed():
        mix_docs, specs, limits = capped_corpus(spark, sf_dir)
        mix_settings = PackSettings(SEQ_LEN, limits.total_tokens, BLOCKS_PER_SHARD, SEED)
        mix_rows, mix_plan = plan_documents(mix_docs, specs, mix_settings, BYTES)
        run(pack(mix_rows, mix_plan, BYTES))
        return mix_plan

    tokens["plan_caps"] = timed("plan_caps", capped).stream_tokens
    tokens["mix_caps_budget"] = timed("mix_caps_budget", mixed).n_blocks * SEQ_LEN

    def words():
        tok = word_tokenizer(build_vocab(docs, 32000))
        table = tokenized(docs, tok)
        word_plan = plan_mix(table, doc_specs(), one_pass)
        run(pack(table, word_plan, tok))
        return word_plan

    tokens["words"] = timed("words", words).n_blocks * SEQ_LEN
    timed("stream", lambda: run(QUERIES["pack_stream"](spark, sf_dir)))
    tokens["stream"] = plan.stream_tokens
    return seconds, tokens


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    measure(spark, warm if os.path.isdir(warm) else sf_dir)
    rounds = [measure(spark, sf_dir) for _ in range(int(os.environ.get("BENCH_ROUNDS", "3")))]
    tokens = rounds[-1][1]
    seconds = {name: median(r[0][name] for r in rounds) for name in rounds[0][0]}
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "tokens_per_sec": {k: round(tokens[k] / max(seconds[k], 1e-9)) for k in seconds},
        "sf": float(scale.group(1)) if scale else sf_dir,
        "cpus": int(cpus),
        "rounds": len(rounds),
        "load": os.getloadavg()[0],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
