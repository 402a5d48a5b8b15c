"""Plain settings objects and the table schemas shared by the modules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Published settings of the corpus build.
DEFAULT_SEQ_LEN = 4096
DEFAULT_BLOCKS_PER_SHARD = 8192
DEFAULT_SEED = 1234
IGNORE_LABEL = -100


@dataclass(frozen=True)
class SourceSpec:
    """One text source: where it is, how often it is drawn, when it stops."""

    name: str
    dataset: str
    config: str | None
    text_col: str
    weight: float
    token_cap: int | None = None


@dataclass(frozen=True)
class PackSettings:
    """Settings of one build. ``total_tokens=None`` reads every source once."""

    seq_len: int = DEFAULT_SEQ_LEN
    total_tokens: int | None = None
    blocks_per_shard: int = DEFAULT_BLOCKS_PER_SHARD
    seed: int = DEFAULT_SEED

    @property
    def budget_blocks(self) -> int | None:
        """The token budget in whole blocks, rounded up."""
        if self.total_tokens is None:
            return None
        return -(-self.total_tokens // self.seq_len)


@dataclass(frozen=True)
class TokenProfile:
    """Special ids of a tokenizer; the defaults are the published ones."""

    vocab_size: int = 128256
    eos_id: int | None = 128012
    pad_id: int | None = 128012
    bos_id: int | None = None


SPEC_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("config", T.StringType()),
    T.StructField("text_col", T.StringType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("token_cap", T.LongType()),
])

PACKED_SCHEMA = T.StructType([
    T.StructField("block_id", T.LongType()),
    T.StructField("input_ids", T.ArrayType(T.IntegerType())),
    T.StructField("source", T.StringType()),
    T.StructField("shard_id", T.IntegerType()),
])

MANIFEST_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("tokens", T.LongType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("time", T.DoubleType()),
])

STATE_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("shard_idx", T.LongType()),
    T.StructField("total_tokens_written", T.LongType()),
    T.StructField("per_source_tokens", T.MapType(T.StringType(), T.LongType())),
    T.StructField("carry", T.ArrayType(T.IntegerType())),
    T.StructField("seq_len", T.IntegerType()),
    T.StructField("blocks_per_shard", T.IntegerType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("read_digest", T.StringType()),
])
