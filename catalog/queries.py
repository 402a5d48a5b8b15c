"""One query per operator, each over whole tables.

Two corpora are used: the ``documents`` table as twenty sources by its own
``source`` column, and a mix of four tables read through source specs.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from blockmill.config import PackSettings, SourceSpec, TokenProfile
from blockmill.functions import (
    ByteTokenizer, append_eos, attention_mask, file_digest, ids_digest,
    lm_labels, resolve_pad, shard_name, to_long_ids,
)
from blockmill.operators import blocks as B, filters as L, mixing as M, progress, ranks as R
from blockmill.operators.prefix import running_start_by_group
from blockmill.operators.training import (
    batch_training_arrays, mask_stats, micro_batches, token_extrema, training_rows,
)
from blockmill.operators.vocabulary import build_vocab, word_tokenizer, words_of
from blockmill.plans.build import build, pack_documents, plan_documents, resume, shards_of
from blockmill.plans.pack import pack, packed_spans
from blockmill.plans.reader import read_batches, read_training_rows
from blockmill.session import few_listing_tasks, folder_names, plain_renames, remove, scratch_path, stored
from blockmill.sources import (
    audit_manifest, load_state, missing_shards, scan_manifest, scan_packed, scan_shard_bytes,
    scan_sources, shard_files, shard_summary, source_specs, spec_list, stream_packed,
    union_sources, validate_specs, write_shards,
)
from blockmill.sources.published import audit_published, publish_shards, scan_published, write_attempt
from blockmill.sources.shards import drop_shards
from blockmill.streaming import ProgressLog, observed, pack_stream, plan_lanes

SEED = 1234
SEQ_LEN = 512
BLOCKS_PER_SHARD = 1024
WORLD = 2
BATCH = 4
LANES = 4
# Lanes of all sources together, once a stream shares them out by volume.
MORE_LANES = 240
VOCABULARY = 5000
STRAY_SHARD = 500_000
BYTES = ByteTokenizer()
PROFILE = TokenProfile(vocab_size=257, eos_id=256, pad_id=256)

MIX_JSON = json.dumps([
    {"name": "documents", "dataset": "documents.parquet", "config": None,
     "text_col": "text", "weight": 5.0, "token_cap": None},
    {"name": "conversations", "dataset": "conversations.parquet", "config": None,
     "text_col": "text", "weight": 2.0, "token_cap": None},
    {"name": "pages", "dataset": "pages.parquet", "config": None,
     "text_col": "html", "weight": 1.5, "token_cap": None},
    {"name": "benchmark", "dataset": "benchmark.parquet", "config": None,
     "text_col": "text", "weight": 0.5, "token_cap": None},
])
DOC_IDS = {
    "documents": "doc_id", "conversations": "conv_id * 100000 + turn",
    "pages": "page_id", "benchmark": "item_id",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("source", "doc_id", "text")


def doc_specs(caps: dict[str, int] | None = None) -> list[SourceSpec]:
    caps = caps or {}
    return [
        SourceSpec(f"src{n}", "documents.parquet", None, "text", 1.0 + n % 3, caps.get(f"src{n}"))
        for n in range(20)
    ]


def settings(total_tokens: int | None = None) -> PackSettings:
    return PackSettings(SEQ_LEN, total_tokens, BLOCKS_PER_SHARD, SEED)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_sources(spark, spec_list(MIX_JSON), sf_dir, DOC_IDS)


def corpus_tokens(docs: DataFrame) -> int:
    stats = M.source_stats(BYTES.sizes(docs))
    return stats.agg(F.sum("tokens")).first()[0]


def capped_corpus(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[SourceSpec], PackSettings]:
    """Four tables, two of them capped, mixed up to one and a half times their size."""
    docs = corpus(spark, sf_dir)
    tokens = corpus_tokens(docs)
    caps = {"pages": tokens // 10, "benchmark": tokens // 50}
    entries = [dict(e, token_cap=caps.get(e["name"])) for e in json.loads(MIX_JSON)]
    return docs, spec_list(json.dumps(entries)), settings(tokens * 3 // 2)


def capped_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[SourceSpec]]:
    """Twenty sources, with a tight cap, a looser one and one never reached."""
    docs = documents(spark, sf_dir)
    tokens = corpus_tokens(docs)
    return docs, doc_specs({"src3": tokens // 100, "src7": tokens // 30, "src11": tokens * 10})


def doc_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), doc_specs(), settings(), BYTES)


def doc_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, plan = plan_documents(documents(spark, sf_dir), doc_specs(), settings(), BYTES)
    return packed_spans(docs, plan)


def doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = L.valid_text(documents(spark, sf_dir))
    return docs.select("source", "doc_id", BYTES.encode(F.col("text")).alias("ids"))


def doc_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id arrays of all documents, cut at the block ends of their mix."""
    with_ids = doc_ids(spark, sf_dir).withColumn("ids", append_eos(F.col("ids"), BYTES.eos_id))
    spans = doc_spans(spark, sf_dir).select("source", "doc_id", "off", "len")
    return B.document_fragments(with_ids.join(spans, ["source", "doc_id"]), SEQ_LEN)


def written(spark: SparkSession, sf_dir: str) -> str:
    """Path of a finished build of the twenty sources."""
    path = scratch_path(spark, "build")
    build(documents(spark, sf_dir), doc_specs(), settings(), BYTES, path)
    return path


def damaged(spark: SparkSession, sf_dir: str) -> str:
    """Path of a build whose first shard was rewritten, whose last is gone, and that has a stray one."""
    path = written(spark, sf_dir)
    rows = scan_packed(spark, shards_of(path))
    last = rows.agg(F.max("block_id")).first()[0] // BLOCKS_PER_SHARD
    # Only the shard that is rewritten has to lie elsewhere meanwhile.
    first = stored(rows.filter(F.col("shard_id") == 0).drop("file", "shard_id"), "rows")
    write_shards(
        first.withColumn("source", F.concat("source", F.lit("x"))), shards_of(path), BLOCKS_PER_SHARD, mode="overwrite")
    drop_shards(spark, shards_of(path), last)
    write_shards(first, shards_of(path), BLOCKS_PER_SHARD, first_shard=STRAY_SHARD, mode="append")
    return path


def block_rows(blocks: DataFrame, *more: str) -> DataFrame:
    return blocks.select("block_id", "source", *more, ids_digest(F.col("input_ids")).alias("digest"))


# Scans and sources

def scan_text_query(spark, sf_dir):
    return corpus(spark, sf_dir).select("source", "doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


def source_specs_query(spark, sf_dir):
    specs = source_specs(spark, MIX_JSON)
    counts = corpus(spark, sf_dir).groupBy(F.col("source").alias("name")).agg(F.count("*").alias("n_records"))
    return specs.join(counts, "name").select("position", "name", "text_col", "weight", "n_records")


def scan_packed_query(spark, sf_dir):
    rows = scan_packed(spark, shards_of(written(spark, sf_dir)))
    return block_rows(rows, "shard_id", "file")


def stream_packed_query(spark, sf_dir):
    """A stream that begins before the first shard and is taken up again after the last."""
    path, places = scratch_path(spark, "build"), stream_places(spark)
    run_stream(spark, stream_packed(spark, shards_of(path), 2), places=places)
    remove(spark, path)
    build(documents(spark, sf_dir), doc_specs(), settings(), BYTES, path)
    out = run_stream(spark, stream_packed(spark, shards_of(path), 2), places=places)
    return block_rows(out, "shard_id")


def scan_manifest_query(spark, sf_dir):
    lines = scan_manifest(spark, written(spark, sf_dir) + "/manifest")
    return lines.select("file", "rows", "tokens")


def shard_bytes_query(spark, sf_dir):
    path = damaged(spark, sf_dir)
    found = scan_shard_bytes(spark, shards_of(path)).select("file", file_digest(F.col("content")).alias("found"))
    lines = scan_manifest(spark, f"{path}/manifest")
    return lines.join(found, "file").select(
        "file", F.length("found").alias("digest_chars"), (F.col("found") == F.col("sha256")).alias("same"))


def state_query(spark, sf_dir):
    state = load_state(spark, written(spark, sf_dir) + "/state")
    return state.select(
        "shard_idx", "total_tokens_written", "seq_len", "blocks_per_shard",
        ids_digest(F.col("carry")).alias("carry_digest"),
        F.explode("per_source_tokens").alias("source", "tokens"))


# Sinks

def write_shards_query(spark, sf_dir):
    path = scratch_path(spark, "shards")
    write_shards(doc_blocks(spark, sf_dir), path, BLOCKS_PER_SHARD)
    files = shard_files(spark, path).groupBy("shard_id").agg(F.count("*").alias("files"))
    rows = shard_summary(scan_packed(spark, path), SEQ_LEN)
    return files.join(rows, "shard_id").select("shard_id", "file", "files", "rows", "tokens")


def publish_shards_query(spark, sf_dir):
    """Two commits, an attempt between them that never gets one; read back and audited."""
    path, split = scratch_path(spark, "published"), 2 * BLOCKS_PER_SHARD
    blocks = stored(doc_blocks(spark, sf_dir), "blocks")
    publish_shards(blocks.filter(F.col("block_id") < split), path, BLOCKS_PER_SHARD)
    write_attempt(blocks.withColumn("source", F.lit("lost")), path, BLOCKS_PER_SHARD)
    publish_shards(
        blocks.filter(F.col("block_id") >= split), path, BLOCKS_PER_SHARD, first_block=split, first_shard=2)
    verdicts = audit_published(spark, path).select("shard_id", "verdict", "rows")
    return block_rows(scan_published(spark, path).join(F.broadcast(verdicts), "shard_id"), "shard_id", "verdict", "rows")


def audit_query(spark, sf_dir):
    path = damaged(spark, sf_dir)
    return audit_manifest(spark, shards_of(path), f"{path}/manifest", SEQ_LEN).select(
        "file", "lines", "rows", "tokens", "verdict")


def missing_shards_query(spark, sf_dir):
    path = written(spark, sf_dir)
    lines = scan_manifest(spark, f"{path}/manifest").filter(F.col("file") != "shard-000001.parquet")
    files = shard_files(spark, shards_of(path)).filter(F.col("shard_id") != 2)
    return missing_shards(lines, files)


# Functions

def digest_of(df: DataFrame, ids: str = "ids") -> DataFrame:
    return df.select("doc_id", F.size(ids).alias("n_ids"), ids_digest(F.col(ids)).alias("digest"))


def tokenize_bytes_query(spark, sf_dir):
    return digest_of(doc_ids(spark, sf_dir))


def validate_specs_query(spark, sf_dir):
    """Which sources of the corpus can be mixed with a weight and a cap taken from their texts."""
    stats = documents(spark, sf_dir).groupBy("source").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.max(F.octet_length("text")).alias("longest"))

    def error(row):
        # No cap is left for a source whose longest text is more than a tenth of it.
        spec = SourceSpec(row["source"], "documents.parquet", None, "text", float(row["n"] % 3), row["bytes"] - 10 * row["longest"])
        try:
            validate_specs([spec])
        except ValueError as problem:
            return "cap" if "token_cap" in str(problem) else "weight"
        return "none"

    # One row per source.
    found = [(r["source"], error(r)) for r in stats.collect()]
    return spark.createDataFrame(found, "source string, error string")


def build_vocab_query(spark, sf_dir):
    return build_vocab(documents(spark, sf_dir), VOCABULARY)


def encode_words_query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    tok = word_tokenizer(build_vocab(docs, VOCABULARY))
    return digest_of(tok.tokenize(docs), "payload")


def pack_words_query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    tok = word_tokenizer(build_vocab(docs, VOCABULARY))
    return block_rows(pack_documents(docs, doc_specs(), settings(), tok), "n_docs")


def pack_words_budget_query(spark, sf_dir):
    """Words packed up to a budget; documents that it does not reach are not tokenised."""
    docs = documents(spark, sf_dir)
    tok = word_tokenizer(build_vocab(docs, VOCABULARY))
    budget = settings(corpus_tokens(docs) // 100)
    return block_rows(pack_documents(docs, doc_specs(), budget, tok), "n_docs")


def append_eos_query(spark, sf_dir):
    with_eos = doc_ids(spark, sf_dir).withColumn("ids", append_eos(F.col("ids"), BYTES.eos_id))
    return digest_of(with_eos)


def block_slices_query(spark, sf_dir):
    return doc_fragments(spark, sf_dir).select(
        "doc_id", "block_id", F.size("fragment").alias("n_ids"), ids_digest(F.col("fragment")).alias("digest"))


def per_block(column: Callable) -> Callable:
    def query(spark, sf_dir):
        return doc_blocks(spark, sf_dir).select(
            "block_id", ids_digest(column(F.col("input_ids"))).alias("digest"))
    return query


def shard_names_query(spark, sf_dir):
    blocks = B.assign_shards(doc_blocks(spark, sf_dir), BLOCKS_PER_SHARD)
    return blocks.select("block_id", shard_name(F.col("shard_id")).alias("file"))


def resolve_pad_query(spark, sf_dir):
    # Pad ids of documents, missing for every third one.
    pad = F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 7)
    eos, vocab = F.lit(256).cast("long"), F.lit(257).cast("long")
    return documents(spark, sf_dir).select(
        "doc_id", resolve_pad(pad, eos, vocab, "build").alias("build_pad"),
        resolve_pad(pad, eos, vocab, "train").alias("train_pad"))


# Filters and guards

def valid_text_query(spark, sf_dir):
    raw = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") % 7 == 0, "").when(
        F.col("n_chars") % 11 == 0, F.lit(None)).when(F.col("n_chars") % 13 == 0, "  ")
        .otherwise(F.col("text")).alias("text"))
    return L.valid_text(raw).select("doc_id", F.octet_length("text").alias("n_bytes"))


def nonempty_ids_query(spark, sf_dir):
    raw = table(spark, sf_dir, "documents").select("doc_id", F.when(
        F.col("n_chars") % 5 == 0, " \t ").otherwise(F.col("text")).alias("text"))
    rows = raw.select("doc_id", words_of(F.col("text")).alias("ids"))
    return L.nonempty_ids(rows).select("doc_id", F.size("ids").alias("n_ids"))


def exact_length_query(spark, sf_dir):
    rows = doc_fragments(spark, sf_dir).withColumnRenamed("fragment", "input_ids")
    return L.exact_length(rows, SEQ_LEN).select("doc_id", "block_id", ids_digest(F.col("input_ids")).alias("digest"))


def token_range_query(spark, sf_dir):
    rows = doc_blocks(spark, sf_dir)
    guarded = L.token_range_guard(rows, PROFILE.vocab_size)
    return guarded.select(
        "block_id", L.out_of_range(F.col("input_ids"), 200).alias("past_200"),
        F.array_max("input_ids").alias("max_id"))


def supervised_batches_query(spark, sf_dir):
    """Fragments as batches of one row; a lone end-of-text supervises nothing."""
    rows = doc_fragments(spark, sf_dir).select(
        "doc_id", "block_id", F.array(lm_labels(F.col("fragment"), PROFILE.pad_id)).alias("labels"))
    return L.supervised_batches(rows).select(
        "doc_id", "block_id", L.n_supervised(F.flatten("labels")).alias("n_labels"))


def event_log(spark, sf_dir):
    """The events as a progress log: one run per user, steps in time order."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "value")
    day = F.floor(F.unix_seconds("ts") / 86400)
    steps = running_start_by_group(events, "run", day, ["ts", "event_id"], F.lit(1), "opt_step")
    loss = F.when(F.col("event_id") % 97 == 0, float("nan")).when(
        F.col("event_id") % 89 == 0, float("inf")).otherwise(F.col("value"))
    return steps.withColumn("opt_step", F.col("opt_step") + 1).withColumn(
        "micro_step", F.col("opt_step") * 8 + F.pmod("event_id", F.lit(3))).withColumn("loss", loss)


def finite_guard_query(spark, sf_dir):
    return event_log(spark, sf_dir).filter(L.not_finite(F.col("loss"))).select("run", "opt_step", "event_id")


def finite_rows_query(spark, sf_dir):
    log = event_log(spark, sf_dir).filter(~L.not_finite(F.col("loss")))
    return L.finite_guard(log).select("run", "opt_step", "loss")


def every_n_query(spark, sf_dir):
    return L.every_n(event_log(spark, sf_dir), 10).select("run", "opt_step", "micro_step")


def progress_rates_query(spark, sf_dir):
    rates = progress.progress_rates(event_log(spark, sf_dir), 4 * SEQ_LEN, 610352, 10)
    return rates.select(
        "run", "opt_step", "tokens", "dt", "tok_per_sec", "eta_hours")


def progress_from_start_query(spark, sf_dir):
    """Rates with the starts of processes: now and then a run begins anew, shortly before a line."""
    log = event_log(spark, sf_dir)
    starts = log.filter(F.col("event_id") % 23 == 0).select(
        "run", (F.col("ts") - F.expr("INTERVAL 7 SECONDS")).alias("ts"), (F.col("micro_step") - 5).alias("micro_step"))
    rates = progress.progress_rates(log, 4 * SEQ_LEN, 610352, 10, starts=starts)
    return rates.select("run", "opt_step", "tokens", "dt", "tok_per_sec", "eta_hours")


# Mixing

def union_sources_query(spark, sf_dir):
    tables = [
        table(spark, sf_dir, "documents").select(F.lit("documents").alias("source"), "doc_id", "text"),
        table(spark, sf_dir, "benchmark").select(
            F.lit("benchmark").alias("source"), F.col("item_id").alias("doc_id"), "text"),
    ]
    return union_sources(tables).select("source", "doc_id", F.octet_length("text").alias("n_bytes"))


def attach_spec_query(spark, sf_dir):
    with_spec = M.attach_spec(corpus(spark, sf_dir), source_specs(spark, MIX_JSON))
    return with_spec.select("source", "doc_id", "weight")


def weighted_interleave_query(spark, sf_dir):
    docs = corpus(spark, sf_dir).select("source", "doc_id")
    counts = docs.groupBy("source").agg(F.count("*").alias("n_records"))
    specs = source_specs(spark, MIX_JSON)
    return M.weighted_interleave(docs, specs, counts, SEED, epochs=2)


def token_caps_query(spark, sf_dir):
    docs, specs = capped_documents(spark, sf_dir)
    rows, plan = plan_documents(docs, specs, settings(), BYTES)
    spans = packed_spans(rows, plan)
    return spans.select("source", "doc_id", "off", B.completed_blocks(
        F.col("off"), F.col("len"), SEQ_LEN).alias("n_blocks"))


def source_available_query(spark, sf_dir):
    docs, specs = capped_documents(spark, sf_dir)
    rows, plan = plan_documents(docs, specs, settings(), BYTES)
    return packed_spans(rows, plan).groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum("len").alias("tokens"))


def repeat_epochs_query(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    budget = settings(corpus_tokens(docs) * 3 // 2)
    rows, plan = plan_documents(docs, spec_list(MIX_JSON), budget, BYTES)
    return packed_spans(rows, plan).select("source", "epoch", "doc_id", "off")


def seeded_shuffle_query(spark, sf_dir):
    return M.seeded_shuffle(documents(spark, sf_dir).select("source", "doc_id"), SEED).select(
        "source", "doc_id", "pos")


def weighted_choice_query(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id")
    return M.weighted_choice(rows, spec_list(MIX_JSON), SEED, ["doc_id"])


def stream_offsets_query(spark, sf_dir):
    return doc_spans(spark, sf_dir).select("source", "doc_id", "off", "len")


def block_overlap_query(spark, sf_dir):
    return B.block_overlap(doc_spans(spark, sf_dir), SEQ_LEN).select("doc_id", "block_id")


# Aggregations

def source_stats_query(spark, sf_dir):
    return M.source_stats(BYTES.sizes(corpus(spark, sf_dir)))


def per_source_tokens_query(spark, sf_dir):
    return B.per_source_tokens(doc_blocks(spark, sf_dir), SEQ_LEN)


def mix_report_query(spark, sf_dir):
    docs, specs = capped_documents(spark, sf_dir)
    rows, plan = plan_documents(docs, specs, settings(), BYTES)
    blocks = pack(rows, plan, BYTES)
    report = B.mix_report(blocks, packed_spans(rows, plan), source_specs(spark, specs), SEQ_LEN)
    return report.drop("token_cap")


def shard_summary_query(spark, sf_dir):
    return shard_summary(B.assign_shards(doc_blocks(spark, sf_dir), BLOCKS_PER_SHARD), SEQ_LEN)


def pack_blocks_query(spark, sf_dir):
    return block_rows(doc_blocks(spark, sf_dir), "n_docs")


def assemble_blocks_query(spark, sf_dir):
    return block_rows(B.assemble_blocks(doc_fragments(spark, sf_dir), SEQ_LEN), "n_docs")


def mixed_corpus_query(spark, sf_dir):
    docs, specs, limits = capped_corpus(spark, sf_dir)
    return block_rows(pack_documents(docs, specs, limits, BYTES), "n_docs")


def token_extrema_query(spark, sf_dir):
    blocks = B.assign_shards(doc_blocks(spark, sf_dir), BLOCKS_PER_SHARD)
    return token_extrema(blocks, "shard_id")


def mask_stats_query(spark, sf_dir):
    blocks = B.assign_shards(doc_blocks(spark, sf_dir), BLOCKS_PER_SHARD)
    return mask_stats(training_rows(blocks, PROFILE.pad_id), "shard_id")


# Shards over ranks, batches

def files_of(spark, sf_dir):
    return shard_files(spark, shards_of(written(spark, sf_dir)))


def sorted_shards_query(spark, sf_dir):
    return R.sorted_shards(files_of(spark, sf_dir)).select("file", "pos")


def shuffled_shards_query(spark, sf_dir):
    return R.shuffled_shards(files_of(spark, sf_dir), SEED).select("file", "pos")


def rank_shards_query(spark, sf_dir):
    return R.rank_shards(files_of(spark, sf_dir), WORLD, SEED).select("file", "rank", "shard_pos")


def rank_coverage_query(spark, sf_dir):
    files = files_of(spark, sf_dir)
    # Rank 1 fell out, rank 0 also reads the first shard twice.
    kept = R.rank_shards(files, WORLD).filter(F.col("rank") == 0)
    twice = kept.filter(F.col("shard_id") == 0).withColumn("rank", F.lit(5))
    return R.rank_coverage(files, kept.unionByName(twice))


def step_plan_query(spark, sf_dir):
    lines = scan_manifest(spark, written(spark, sf_dir) + "/manifest")
    return R.step_plan(lines, SEQ_LEN, BATCH, WORLD, 1)


def micro_batches_query(spark, sf_dir):
    path = shards_of(written(spark, sf_dir))
    ranks = R.rank_shards(shard_files(spark, path), WORLD)
    batches = batch_training_arrays(
        micro_batches(scan_packed(spark, path), ranks, BATCH, SEQ_LEN), PROFILE.pad_id)
    return batches.select(
        "rank", "batch_id", F.size("input_ids").alias("n_rows"),
        ids_digest(F.flatten("input_ids")).alias("digest"),
        L.n_supervised(F.flatten("labels")).alias("valid_labels"))


def training_rows_query(spark, sf_dir):
    rows = read_training_rows(spark, shards_of(written(spark, sf_dir)), SEQ_LEN, PROFILE, WORLD)
    return rows.select(
        "rank", "shard_pos", "block_id", ids_digest(F.col("labels")).alias("labels_digest"),
        ids_digest(F.col("attention_mask")).alias("mask_digest"))


def read_batches_query(spark, sf_dir):
    batches = read_batches(spark, shards_of(written(spark, sf_dir)), SEQ_LEN, PROFILE, BATCH, WORLD, SEED)
    return batches.select("rank", "batch_id", ids_digest(F.flatten("input_ids")).alias("digest"))


def read_published_query(spark, sf_dir):
    """The same batches from shards that a commit has published."""
    path = scratch_path(spark, "published")
    publish_shards(doc_blocks(spark, sf_dir), path, BLOCKS_PER_SHARD)
    batches = read_batches(spark, path, SEQ_LEN, PROFILE, BATCH, WORLD, SEED)
    return batches.select("rank", "batch_id", ids_digest(F.flatten("input_ids")).alias("digest"))


def assign_shards_query(spark, sf_dir):
    return B.assign_shards(doc_blocks(spark, sf_dir), BLOCKS_PER_SHARD).select("block_id", "shard_id", "source")


def budget_cut_query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    tokens = corpus_tokens(docs) // 2
    # Later buckets are left out before the shuffle; the cut is then the same.
    blocks = pack_documents(docs, doc_specs(), settings(), BYTES, end_block=-(-tokens // SEQ_LEN))
    return B.budget_cut(blocks, tokens, SEQ_LEN).select("block_id", "source")


def head_blocks_query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    n = corpus_tokens(docs) // SEQ_LEN // 10
    return block_rows(B.head_blocks(pack_documents(docs, doc_specs(), settings(), BYTES, end_block=n), n))


# Streams and continuation

def stream_places(spark) -> tuple[str, str]:
    """Folders for the rows and for the state of a stream."""
    return scratch_path(spark, "stream"), scratch_path(spark, "stream-state")


def run_stream(
    spark, stream: DataFrame, log: ProgressLog | None = None, places: tuple[str, str] | None = None
) -> DataFrame | None:
    """Run a stream to its present end into a table of the shared folder, if it has rows."""
    if log is not None:
        spark.streams.addListener(log)
    out, state = places or stream_places(spark)
    # The stream lists its folders and writes its logs while it runs.
    with few_listing_tasks(spark), plain_renames(spark, out, state):
        query = (
            stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
            .outputMode("append").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    if log is not None:
        log.wait_for(query)
        spark.streams.removeListener(log)
    # Until it has written rows, a stream's table has no files.
    names = [n for n in folder_names(spark, out) if n.startswith("part-")]
    return spark.read.parquet(out) if names else None


def document_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "documents").schema
    docs = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents*.parquet")
    return pack_stream(docs, BYTES, SEQ_LEN, LANES, SEED)


def pack_stream_query(spark, sf_dir):
    blocks = run_stream(spark, document_stream(spark, sf_dir))
    return blocks.groupBy("source", "lane").agg(
        F.count("*").alias("n_blocks"), F.max("seq").alias("last_seq"),
        F.sum(F.size("input_ids")).alias("tokens"))


def pack_stream_lanes_query(spark, sf_dir):
    """English documents arrive first, then all others; these find lanes by the volume packed before."""
    docs, folder, places = table(spark, sf_dir, "documents"), scratch_path(spark, "arrivals"), stream_places(spark)
    early = F.coalesce(F.col("lang") == "en", F.lit(False))

    def run(lanes):
        stream = spark.readStream.schema(docs.schema).parquet(folder)
        return run_stream(spark, pack_stream(stream, BYTES, SEQ_LEN, lanes, SEED), places=places)

    docs.filter(early).write.mode("append").parquet(folder)
    first = run(LANES)
    seen = stored(B.per_source_tokens(first, SEQ_LEN), "lane-volumes")
    before = {r["source"]: LANES for r in seen.collect()}
    docs.filter(~early).write.mode("append").parquet(folder)
    return run(plan_lanes(seen, MORE_LANES, before)).groupBy("source", "lane").agg(
        F.count("*").alias("n_blocks"), F.max("seq").alias("last_seq"),
        F.sum(F.size("input_ids")).alias("tokens"))


def progress_stream_query(spark, sf_dir):
    log = ProgressLog()
    out = run_stream(spark, observed(document_stream(spark, sf_dir)), log)
    stored = out.agg(F.count("*").alias("stored_blocks"))
    return stored.select(
        "stored_blocks", F.lit(log.blocks).cast("long").alias("seen_blocks"),
        F.lit(log.tokens).cast("long").alias("seen_tokens"))


def stream_rows_query(spark, sf_dir):
    """Shards read as a stream of training rows, some files at a time."""
    shards = stream_packed(spark, shards_of(written(spark, sf_dir)), 2)
    rows = L.token_range_guard(L.exact_length(shards, SEQ_LEN), PROFILE.vocab_size)
    return mask_stats(run_stream(spark, training_rows(rows, PROFILE.pad_id)), "shard_id")


def resume_query(spark, sf_dir):
    """Half of the mix, a broken attempt, then the rest into the same folder."""
    docs, specs, limits = capped_corpus(spark, sf_dir)
    path = scratch_path(spark, "build")
    plan = build(docs, specs, settings(limits.total_tokens // 2), BYTES, path)
    # What a larger attempt leaves that breaks before its state: stray shards past the last one.
    stray = pack_documents(documents(spark, sf_dir), doc_specs(), settings(), BYTES, whole_shards=True)
    write_shards(
        stray.drop("n_docs"), shards_of(path), BLOCKS_PER_SHARD,
        first_shard=-(-plan.n_blocks // BLOCKS_PER_SHARD), mode="append", clustered=True,
    )
    resume(docs, specs, limits, BYTES, path)
    return block_rows(scan_packed(spark, shards_of(path)), "shard_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_text": scan_text_query,
    "source_specs": source_specs_query,
    "scan_packed": scan_packed_query,
    "stream_packed": stream_packed_query,
    "scan_manifest": scan_manifest_query,
    "shard_bytes": shard_bytes_query,
    "load_state": state_query,
    "write_shards": write_shards_query,
    "publish_shards": publish_shards_query,
    "audit_manifest": audit_query,
    "missing_shards": missing_shards_query,
    "tokenize_bytes": tokenize_bytes_query,
    "build_vocab": build_vocab_query,
    "encode_words": encode_words_query,
    "validate_specs": validate_specs_query,
    "pack_words": pack_words_query,
    "pack_words_budget": pack_words_budget_query,
    "append_eos": append_eos_query,
    "block_slices": block_slices_query,
    "attention_mask": per_block(lambda ids: attention_mask(ids, PROFILE.pad_id)),
    "lm_labels": per_block(lambda ids: lm_labels(ids, PROFILE.pad_id)),
    "long_ids": per_block(to_long_ids),
    "shard_names": shard_names_query,
    "resolve_pad": resolve_pad_query,
    "valid_text": valid_text_query,
    "nonempty_ids": nonempty_ids_query,
    "exact_length": exact_length_query,
    "token_range": token_range_query,
    "supervised_batches": supervised_batches_query,
    "finite_guard": finite_guard_query,
    "finite_rows": finite_rows_query,
    "every_n": every_n_query,
    "progress_rates": progress_rates_query,
    "progress_from_start": progress_from_start_query,
    "union_sources": union_sources_query,
    "attach_spec": attach_spec_query,
    "weighted_interleave": weighted_interleave_query,
    "token_caps": token_caps_query,
    "source_available": source_available_query,
    "repeat_epochs": repeat_epochs_query,
    "seeded_shuffle": seeded_shuffle_query,
    "weighted_choice": weighted_choice_query,
    "stream_offsets": stream_offsets_query,
    "block_overlap": block_overlap_query,
    "source_stats": source_stats_query,
    "per_source_tokens": per_source_tokens_query,
    "mix_report": mix_report_query,
    "shard_summary": shard_summary_query,
    "pack_blocks": pack_blocks_query,
    "assemble_blocks": assemble_blocks_query,
    "mixed_corpus": mixed_corpus_query,
    "token_extrema": token_extrema_query,
    "mask_stats": mask_stats_query,
    "sorted_shards": sorted_shards_query,
    "shuffled_shards": shuffled_shards_query,
    "rank_shards": rank_shards_query,
    "rank_coverage": rank_coverage_query,
    "step_plan": step_plan_query,
    "micro_batches": micro_batches_query,
    "training_rows": training_rows_query,
    "read_batches": read_batches_query,
    "read_published": read_published_query,
    "assign_shards": assign_shards_query,
    "budget_cut": budget_cut_query,
    "head_blocks": head_blocks_query,
    "stream_rows": stream_rows_query,
    "pack_stream": pack_stream_query,
    "pack_stream_lanes": pack_stream_lanes_query,
    "progress_stream": progress_stream_query,
    "resume": resume_query,
}
