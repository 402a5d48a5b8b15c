"""Packing as a stream: every lane keeps the tokens that do not fill a block yet."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from blockmill.config import DEFAULT_SEED
from blockmill.functions.hashing import unit_hash
from blockmill.operators.prefix import MAX_BUCKETS

# Ids travel as bytes: an array in a frame would become a Python object for every id.
OUTPUT = "source string, lane int, seq long, raw binary"
STATE = "carry array<int>, n long"
DEFAULT_LANES = 16
# Ids that a lane holds beside its input, whatever the size of its documents.
TOKENS_AT_ONCE = 1 << 20


def plan_lanes(
    tokens: DataFrame, total: int, before: Mapping[str, int] | None = None
) -> dict[str, int]:
    """Lanes for every source by its share of the ``tokens`` seen (source, tokens).

    About ``total`` lanes are shared out, one at least to a source, so a source with a
    third of the tokens has a third of the lanes. No source gets fewer than ``before``:
    a lane that nobody writes to any more would keep its last tokens for ever. The driver
    sees one row per source. Null tokens count as none; a null source has no entry.
    """
    if not 0 < total <= MAX_BUCKETS:
        raise ValueError(f"{total} lanes are not within 1 and {MAX_BUCKETS}")
    sums = tokens.filter("source is not null").groupBy("source").agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("tokens")).collect()
    lanes = dict(before or {})
    whole = sum(r["tokens"] for r in sums)
    for r in sums:
        wanted = -(-total * r["tokens"] // whole) if whole else 1
        lanes[r["source"]] = max(1, wanted, lanes.get(r["source"], 0))
    return lanes


def _lane(u: Column, lanes: int | Mapping[str, int]) -> Column:
    if isinstance(lanes, int):
        n = F.lit(float(max(1, lanes)))
    else:
        known = F.create_map(*[F.lit(x) for s, k in lanes.items() for x in (s, float(k))]) if lanes else None
        other = F.lit(float(DEFAULT_LANES))
        n = other if known is None else F.coalesce(F.try_element_at(known, F.coalesce("source", F.lit(""))), other)
    return F.least(F.floor(u * n), n - 1).cast("int")


def _pieces(payloads: pd.Series, read: Callable, end: np.ndarray) -> Iterator[np.ndarray]:
    """The ids of documents one after the other, a bounded number at a time."""
    parts, size = [], 0
    for payload in payloads:
        for ids in (read(payload), end):
            for at in range(0, len(ids), TOKENS_AT_ONCE):
                parts.append(ids[at: at + TOKENS_AT_ONCE])
                size += len(parts[-1])
                if size >= TOKENS_AT_ONCE:
                    yield np.concatenate(parts, dtype=np.int32)
                    parts, size = [], 0
    if parts:
        yield np.concatenate(parts, dtype=np.int32)


def _filled(
    key: tuple, batches: Iterator[pd.DataFrame], state: GroupState, read: Callable, end: np.ndarray, seq_len: int
) -> Iterator[pd.DataFrame]:
    """Full blocks of a lane; what is left of its tokens goes into the state."""
    carry, n = state.get if state.exists else ([], 0)
    carry = np.asarray(carry, dtype=np.int32)
    for batch in batches:
        for tokens in _pieces(batch["payload"], read, end):
            tokens = np.concatenate([carry, tokens])
            full = len(tokens) // seq_len
            # A copy, so that what is left does not keep the whole piece.
            carry = tokens[full * seq_len:].copy()
            if full:
                yield pd.DataFrame({
                    "source": key[0], "lane": key[1], "seq": np.arange(n, n + full),
                    "raw": [block.tobytes() for block in tokens[: full * seq_len].reshape(full, seq_len)],
                })
                n += full
    state.update((carry.tolist(), n))


def _ids(seq_len: int) -> Callable[[Column], Column]:
    """The ids of blocks that came as bytes."""

    @F.arrow_udf("array<int>")
    def ids(raw: pa.Array) -> pa.Array:
        values = np.frombuffer(b"".join(raw.to_pylist()), dtype=np.int32)
        offsets = np.arange(len(raw) + 1, dtype=np.int64) * seq_len
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))

    return ids


def pack_stream(
    docs: DataFrame, tokenizer, seq_len: int, lanes: int | Mapping[str, int] = DEFAULT_LANES,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Full blocks of a stream of documents (source, doc_id, text), in append mode.

    A lane is a source and a hash of the document, so that one large source is
    packed by many tasks. Each lane carries less than one block between triggers;
    the checkpoint of the query keeps it, which makes the stream resumable.
    ``seq`` numbers the blocks of a lane.

    ``lanes`` is one number for all sources or a number for each (others get 16). A stream
    that goes on from its checkpoint may be given more lanes, as ``plan_lanes`` finds
    them from the blocks so far: the lanes that were there go on with what they carry, new
    ones begin empty, and no token is lost or doubled. Fewer lanes are not safe.
    """
    read = tokenizer.reader()
    end = np.asarray([] if tokenizer.eos_id is None else [tokenizer.eos_id], dtype=np.int32)

    def fill(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        return _filled(key, batches, state, read, end, seq_len)

    lane = _lane(unit_hash(seed, F.col("source"), F.col("doc_id")), lanes)
    payload = tokenizer.for_python(F.col("payload"))
    keyed = tokenizer.tokenize(docs.select("source", "doc_id", "text")).filter("n_tok > 0")
    return (
        keyed.select("source", lane.alias("lane"), payload.alias("payload"))
        .groupBy("source", "lane")
        .applyInPandasWithState(fill, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
        # Keeps all rows; Spark's Python stages take rows in its binary form only, which a filter leaves.
        .filter(F.col("raw").isNotNull())
        .select("source", "lane", "seq", _ids(seq_len)(F.col("raw")).alias("input_ids"))
    )
