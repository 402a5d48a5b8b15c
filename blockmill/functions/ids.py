"""Column functions on token-id arrays and shard names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from blockmill.config import IGNORE_LABEL


def append_eos(ids: Column, eos_id: int | None) -> Column:
    """The ids followed by the end-of-text id; unchanged without one."""
    if eos_id is None:
        return ids
    return F.array_append(ids, F.lit(eos_id).cast("int"))


def block_slice(ids: Column, off: Column, block_id: Column, seq_len: int) -> Column:
    """The part of a document starting at stream position ``off`` that lies in a block."""
    length = F.size(ids)
    begin = F.greatest(off, block_id * seq_len)
    end = F.least(off + length, (block_id + 1) * seq_len)
    return F.slice(ids, (begin - off + 1).cast("int"), (end - begin).cast("int"))


def to_long_ids(ids: Column) -> Column:
    return ids.cast("array<bigint>")


def attention_mask(ids: Column, pad_id: int | None) -> Column:
    """1 for every id that is not padding, else 0."""
    if pad_id is None:
        return F.transform(ids, lambda _: F.lit(1).cast("long"))
    return F.transform(ids, lambda x: (x != F.lit(pad_id)).cast("long"))


def lm_labels(ids: Column, pad_id: int | None, ignore: int = IGNORE_LABEL) -> Column:
    """The id itself, or the ignore label at padding."""
    if pad_id is None:
        return to_long_ids(ids)
    return F.transform(
        ids,
        lambda x: F.when(x != F.lit(pad_id), x.cast("long")).otherwise(F.lit(ignore).cast("long")),
    )


def shard_name(shard_id: Column) -> Column:
    return F.format_string("shard-%06d.parquet", shard_id)


def resolve_pad(pad: Column, eos: Column, vocab_size: Column, mode: str) -> Column:
    """Fallback for a missing padding id.

    ``mode="build"`` reuses the end-of-text id; ``mode="train"`` adds a new id
    just past the vocabulary.
    """
    if mode == "build":
        return F.coalesce(pad, eos)
    if mode == "train":
        return F.coalesce(pad, vocab_size)
    raise ValueError(f"mode must be 'build' or 'train', not {mode!r}")


def file_digest(content: Column) -> Column:
    return F.sha2(content, 256)


def ids_digest(ids: Column) -> Column:
    """A short fingerprint of an id array, for comparing blocks: of its decimals joined by commas.

    JSON gives the decimals without a string for each of them. Only where ids are missing,
    which are left out, or one is -1, they are joined one by one.
    """
    text = F.to_json(F.when(~F.array_contains(ids, F.lit(-1)), ids)).cast("binary")
    joined = F.array_join(ids.cast("array<string>"), ",").cast("binary")
    return F.md5(F.coalesce(F.substring(text, F.lit(2), F.octet_length(text) - 2), joined))
