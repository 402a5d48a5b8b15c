"""Whole builds: mix, pack, write, list and remember; and their continuation."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from blockmill.config import PackSettings, SourceSpec
from blockmill.plans.measure import TokenSlices, content, spread
from blockmill.plans.mix import MixPlan, plan_budget, plan_mix
from blockmill.plans.pack import pack, packed_spans, stage_waves
from blockmill.session import exists, folder_names, remove, stored
from blockmill.sources.manifest import append_lines, lines_of, trim_manifest
from blockmill.sources.shards import drop_shards, write_shards, written_shards
from blockmill.sources.state import (
    fingerprint, load_state, newest_state, save_identity, save_state, saved_identity,
)

# A wave has at least so many shards, a build about so many waves at most.
WAVE_SHARDS = 64
MAX_WAVES = 8


def tokenized(docs: DataFrame, tokenizer) -> DataFrame:
    """Tokenised documents, written once where tokenising needs Python.

    Planning and packing both use the token counts; reading them back from a
    table in the shared folder keeps the tokenizer to one run, and lost
    executors cost no more than the files they were writing.
    """
    docs = docs.select("source", "doc_id", "text")
    if not tokenizer.costly:
        return tokenizer.tokenize(docs)
    return stored(tokenizer.tokenize(spread(docs)), "tokens")


def plan_documents(
    docs: DataFrame, specs: Sequence[SourceSpec], settings: PackSettings, tokenizer,
    keep: str | None = None,
) -> tuple[DataFrame, MixPlan]:
    """Tokenised documents with the plan of their mix.

    A costly tokenizer runs over the documents that the budget reaches, or over those
    of all drawn sources where there is no budget; ``keep`` names the folder for them.
    """
    eos = tokenizer.eos_id is not None
    if not tokenizer.costly:
        return tokenized(docs, tokenizer), plan_mix(tokenizer.sizes(docs), specs, settings, eos)
    drawn = [s.name for s in specs if s.weight > 0]
    slices = TokenSlices(docs, tokenizer, settings.seed, drawn, keep)
    if settings.total_tokens is not None:
        plan = plan_budget(slices, specs, settings, eos)
        return slices.rows, plan
    rows = slices.reach(dict.fromkeys(drawn, 1.0))
    return rows, plan_mix(rows, specs, settings, eos)


def pack_documents(
    docs: DataFrame, specs: Sequence[SourceSpec], settings: PackSettings, tokenizer,
    end_block: int | None = None, whole_shards: bool = False,
) -> DataFrame:
    """The blocks of a mix as a table, nothing written; or those before ``end_block``.

    With ``whole_shards`` they are ready for a clustered ``write_shards``.
    """
    rows, plan = plan_documents(docs, specs, settings, tokenizer)
    return pack(rows, plan, tokenizer, whole_shards=whole_shards, end_block=end_block)


def shards_of(path: str) -> str:
    """Folder of the shards of a build."""
    return f"{path}/packed/part=shards"


def _write(
    rows: DataFrame, plan: MixPlan, tokenizer, path: str, first_block: int, end_block: int, first_shard: int,
    placed: bool = False,
) -> None:
    """One pass over the rows: shards, and at the end of the plan the unpacked tokens
    in a folder of their own."""
    blocks = pack(
        rows, plan, tokenizer, first_block, whole_shards=True,
        with_tail=end_block == plan.n_blocks, end_block=end_block, placed=placed,
    )
    part = F.when(F.col("block_id") < plan.n_blocks, "shards").otherwise("carry")
    write_shards(
        blocks.withColumn("part", part), f"{path}/packed", plan.settings.blocks_per_shard,
        first_block, first_shard, "overwrite", clustered=True, by=("part",),
    )


def _finish(
    spark: SparkSession, plan: MixPlan, path: str, end_block: int, first_shard: int, next_shard: int, print_id: str,
    read: str | None,
) -> None:
    """Manifest lines of new shards, then the state. Only the last state of a plan has a carry."""
    settings = plan.settings
    # A few numbers for each shard of this wave; those of earlier ones are in the last state.
    written = written_shards(spark, shards_of(path), (first_shard, next_shard)).persist()
    try:
        append_lines(lines_of(written, settings.seq_len), f"{path}/manifest")
        rows = written.select(F.inline("sources"))
        counts = rows.select("source", (F.col("rows") * F.lit(settings.seq_len).cast("long")).alias("tokens"))
        before = load_state(spark, f"{path}/state").filter(F.col("shard_idx") == first_shard)
        counts = before.select(F.explode("per_source_tokens").alias("source", "tokens")).unionByName(counts)
        counts = counts.groupBy("source").agg(F.sum("tokens").alias("tokens")).agg(
            F.map_from_entries(F.collect_list(F.struct("source", "tokens"))).alias("per_source_tokens")
        )
        save_state(_state(spark, counts, plan, path, end_block, next_shard, print_id, read), f"{path}/state")
    finally:
        written.unpersist()


def _carry(spark: SparkSession, plan: MixPlan, path: str, end_block: int) -> DataFrame:
    """The tokens that are left after the last block of a plan, in a row or none."""
    # Before the end the folder is not looked at: the next wave may be writing it.
    if end_block < plan.n_blocks or not exists(spark, f"{path}/packed/part=carry"):
        return spark.createDataFrame([], "carry array<int>")
    rows = spark.read.parquet(f"{path}/packed/part=carry").filter(F.col("block_id") == end_block)
    return rows.select(F.col("input_ids").alias("carry"))


def _state(
    spark: SparkSession, counts: DataFrame, plan: MixPlan, path: str, end_block: int, next_shard: int, print_id: str,
    read: str | None,
) -> DataFrame:
    settings, carry = plan.settings, _carry(spark, plan, path, end_block)
    return (
        counts.unionByName(carry, allowMissingColumns=True)
        .agg(
            F.first("per_source_tokens", ignorenulls=True).alias("per_source_tokens"),
            F.coalesce(
                F.first("carry", ignorenulls=True), F.array().cast("array<int>")
            ).alias("carry"),
        )
        .select(
            F.lit(end_block).cast("long").alias("version"),
            F.lit(next_shard).cast("long").alias("shard_idx"),
            F.lit(end_block * settings.seq_len).cast("long").alias("total_tokens_written"),
            "per_source_tokens",
            "carry",
            F.lit(settings.seq_len).alias("seq_len"),
            F.lit(settings.blocks_per_shard).alias("blocks_per_shard"),
            F.lit(print_id).alias("fingerprint"),
            F.lit(read).cast("string").alias("read_digest"),
        )
    )


def _read_digest(rows: DataFrame, plan: MixPlan, end_block: int) -> str | None:
    """What the plan reads before a block, where its identity does not know all tokens."""
    if plan.keys is None:
        return None
    spans = packed_spans(rows, plan).filter(F.col("off") < end_block * plan.settings.seq_len)
    n, total = spans.agg(F.count("*"), content("source", "epoch", "doc_id", "n_tok")).first()
    return f"{n}:{total}"


def _identity(specs, plan: MixPlan, tokenizer) -> str:
    return fingerprint(specs, plan.settings, tokenizer.name, tokenizer.eos_id, plan.inputs)


def _go_on(
    rows: DataFrame, plan: MixPlan, tokenizer, path: str, first_block: int, first_shard: int,
    print_id: str, wave_shards: int | None,
) -> None:
    """Write what is left of the plan in waves of whole shards, each with its lines and state.

    Where there are several waves, one pass over the text deals the documents out to
    folders, one for each, so a wave reads its own documents and no others. Folders that a
    broken attempt has left serve again if the plan is the same. While a wave is written,
    the one before it gets its lines and state, always one after the other.
    """
    spark, per_shard = rows.sparkSession, plan.settings.blocks_per_shard
    left = -(-(plan.n_blocks - first_block) // per_shard)
    wave = wave_shards or max(WAVE_SHARDS, -(-left // MAX_WAVES))
    start, wave, staged = _staged(rows, plan, path, first_block, wave, left > wave, print_id)

    @inheritable_thread_target(spark)
    def remember(end_block: int, first_shard: int, next_shard: int) -> None:
        read = _read_digest(rows, plan, end_block)
        _finish(spark, plan, path, end_block, first_shard, next_shard, print_id, read)

    with ThreadPoolExecutor(1) as aside:
        before = None
        while first_block < plan.n_blocks:
            number = (first_block - start) // (wave * per_shard)
            end_block = min(plan.n_blocks, first_block + wave * per_shard)
            next_shard = first_shard + -(-(end_block - first_block) // per_shard)
            own = rows if staged is None else spark.read.parquet(f"{staged}/wave={number}")
            try:
                _write(own, plan, tokenizer, path, first_block, end_block, first_shard, staged is not None)
            finally:
                # Also where this wave breaks, the one before is remembered, or its own error raised.
                if before is not None:
                    before.result()
            before = aside.submit(remember, end_block, first_shard, next_shard)
            first_block, first_shard = end_block, next_shard
        if before is not None:
            before.result()
    remove(spark, f"{path}/tokens")
    remove(spark, f"{path}/staged")


def _staged(
    rows: DataFrame, plan: MixPlan, path: str, first_block: int, wave_shards: int, several: bool, print_id: str
) -> tuple[int, int, str | None]:
    """First block, shards a wave, and folder of the documents dealt out to waves, if any.

    The folder's name tells its layout and the plan, whose buckets its rows carry.
    """
    spark, per_shard = rows.sparkSession, plan.settings.blocks_per_shard
    marks = [print_id, plan.lanes, plan.n_buckets, plan.n_blocks, plan.starts.tolist()]
    key = hashlib.sha256(repr(marks).encode()).hexdigest()[:32]
    for name in folder_names(spark, f"{path}/staged"):
        found, begin, size = (*name.split("-"), "", "")[:3]
        if found == key and exists(spark, f"{path}/staged/{name}/_SUCCESS"):
            begin, size = int(begin), int(size)
            if begin <= first_block and (first_block - begin) % (size * per_shard) == 0:
                return begin, size, f"{path}/staged/{name}"
    remove(spark, f"{path}/staged")
    if not several:
        return first_block, wave_shards, None
    folder = f"{path}/staged/{key}-{first_block}-{wave_shards}"
    stage_waves(rows, plan, folder, first_block, wave_shards * per_shard)
    return first_block, wave_shards, folder


def _clean(spark: SparkSession, path: str, first_shard: int) -> None:
    """Remove what a broken attempt has left past the last remembered shard."""
    drop_shards(spark, shards_of(path), first_shard)
    trim_manifest(spark, f"{path}/manifest", first_shard)


def build(
    docs: DataFrame, specs: Sequence[SourceSpec], settings: PackSettings, tokenizer, path: str,
    wave_shards: int | None = None,
) -> MixPlan:
    """A fresh build into an empty folder: identity, shards, manifest and state."""
    spark = docs.sparkSession
    for name in ("state", "plan", "packed"):
        if exists(spark, f"{path}/{name}"):
            raise FileExistsError(f"{path} holds a build already; use resume")
    return _start(docs, specs, settings, tokenizer, path, wave_shards)


def _start(docs, specs, settings, tokenizer, path, wave_shards) -> MixPlan:
    spark = docs.sparkSession
    rows, plan = plan_documents(docs, specs, settings, tokenizer, f"{path}/tokens")
    if plan.n_blocks == 0:
        raise ValueError(f"the sources hold less than one block of {settings.seq_len} tokens")
    print_id = _identity(specs, plan, tokenizer)
    known = saved_identity(spark, f"{path}/plan")
    if known not in (None, print_id):
        raise ValueError(f"{path} was begun from other sources or settings")
    _clean(spark, path, 0)
    save_identity(spark, f"{path}/plan", print_id)
    _go_on(rows, plan, tokenizer, path, 0, 0, print_id, wave_shards)
    return plan


def resume(
    docs: DataFrame, specs: Sequence[SourceSpec], settings: PackSettings, tokenizer, path: str,
    wave_shards: int | None = None,
) -> MixPlan:
    """Continue a build up to a larger budget or after a break, or start it.

    The order of the documents is a function of inputs and settings alone, so the
    new blocks are the next ones of the same sequence. A short last shard stays
    short, as its line in the manifest says. Other inputs or settings raise, also
    where a broken attempt has left no state yet. Shards that no state remembers
    are removed first.
    """
    spark = docs.sparkSession
    state = newest_state(spark, f"{path}/state")
    if state is None:
        return _start(docs, specs, settings, tokenizer, path, wave_shards)
    rows, plan = plan_documents(docs, specs, settings, tokenizer, f"{path}/tokens")
    print_id = _identity(specs, plan, tokenizer)
    if print_id != state["fingerprint"]:
        raise ValueError(f"{path} was built from other sources or settings")
    packed_blocks = state["total_tokens_written"] // settings.seq_len
    if state["read_digest"] is not None and packed_blocks <= plan.n_blocks:
        if _read_digest(rows, plan, packed_blocks) != state["read_digest"]:
            raise ValueError(f"{path} was built from other sources or settings: documents have changed")
    first_shard = state["shard_idx"]
    _clean(spark, path, first_shard)
    _go_on(rows, plan, tokenizer, path, packed_blocks, first_shard, print_id, wave_shards)
    return plan
