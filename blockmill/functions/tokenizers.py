"""Pluggable tokenizers.

A tokenizer adds ``payload`` and ``n_tok`` to a table of documents and knows how
to cut a payload and turn its pieces into ids. The byte tokenizer needs no
Python: its payload is the text itself, which is what the packing shuffles. The
word and file tokenizers produce id arrays in Arrow batches, so their result is
written once and read back (``costly = True``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from blockmill.functions.ids import append_eos

# A byte id travels as the character with that code point; end-of-text is the
# first character after them.
_EOS_CHAR = chr(256)

# Fixed value: the white space that separates words.
WORD_SPLIT = "[ \t\n\r]+"


def _usable(text: Column) -> Column:
    return text.isNotNull() & (text != F.lit(""))


# Ids that pass through Python strings at a time.
_IDS_AT_ONCE = 1 << 22


class ByteTokenizer:
    """Ids 0-255 are the UTF-8 bytes of the text, 256 is end-of-text."""

    name = "byte"
    costly = False
    vocab_size = 257

    def __init__(self, eos: bool = True):
        self.eos_id = 256 if eos else None

    def count(self, text: Column) -> Column:
        return F.when(_usable(text), F.octet_length(text)).otherwise(0).cast("long")

    def tokenize(self, docs: DataFrame) -> DataFrame:
        return docs.withColumn("n_tok", self.count(F.col("text"))).withColumnRenamed("text", "payload")

    def sizes(self, docs: DataFrame) -> DataFrame:
        """Token counts without the payload."""
        return docs.select("source", "doc_id", self.count(F.col("text")).alias("n_tok"))

    def encode(self, text: Column) -> Column:
        """Text to ids as one column expression, without end-of-text."""
        chars = F.decode(text.cast("binary"), "ISO-8859-1")
        return F.transform(F.split(chars, ""), lambda c: F.ascii(c))

    def for_python(self, payload: Column) -> Column:
        """The payload in the form that ``reader`` takes."""
        return payload.cast("binary")

    def reader(self) -> Callable[[bytes], np.ndarray]:
        """A function from one payload to its ids, for use inside Python tasks."""

        def read(payload: bytes) -> np.ndarray:
            return np.frombuffer(payload, dtype=np.uint8)

        return read

    def pieces(self, payload: Column, blocks: Column, cut: Callable) -> Column:
        """One struct per block a document touches; ``cut`` gives begin, length, closes."""

        def per_document(raw: Column) -> Column:
            def piece(block: Column) -> Column:
                begin, length, closes = cut(block)
                chars = F.decode(F.substring(raw, begin + 1, length), "ISO-8859-1")
                if self.eos_id is not None:
                    chars = F.concat(chars, F.when(closes, _EOS_CHAR).otherwise(""))
                return F.struct(block.alias("block_id"), chars.alias("piece"))

            return F.transform(blocks, piece)

        # The one-element array binds the byte form once per document, so that
        # cutting stays linear in the length of the document.
        return F.get(F.transform(F.array(payload.cast("binary")), per_document), F.lit(0))

    def assemble(self, pieces: Column) -> Column:
        """Ids of a whole block, by widening all characters of a batch at once.

        Measured on 500 million tokens this takes a quarter of the time of
        ``encode``, which makes an object of every character.
        """

        @F.arrow_udf("array<int>")
        def widen(batch: pa.Array) -> pa.Array:
            lengths = pc.utf8_length(batch).to_numpy(zero_copy_only=False).astype(np.int64)
            if lengths.sum() >= 1 << 31:
                raise ValueError(
                    "a batch holds more than 2^31 ids; lower spark.sql.execution.arrow.maxRecordsPerBatch"
                )
            ids = np.empty(int(lengths.sum()), np.int32)
            ends = np.cumsum(lengths)
            # A bounded number of ids goes through Python strings at a time.
            first = 0
            while first < len(batch):
                begin = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, begin + _IDS_AT_ONCE, "right")))
                text = "".join(batch.slice(first, last - first).to_pylist())
                ids[begin: int(ends[last - 1])] = np.frombuffer(text.encode("utf-32-le"), dtype=np.int32)
                first = last
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))

        return widen(F.array_join(pieces, ""))


class _ArrayTokenizer:
    """Shared part of tokenizers whose payload is an id array."""

    costly = True
    eos_id: int | None

    def encode(self, text: Column) -> Column:
        raise NotImplementedError

    def tokenize(self, docs: DataFrame) -> DataFrame:
        usable = _usable(F.col("text"))
        # Invalid rows stay, with no tokens: they use up a draw in the mix.
        encoded = docs.withColumn("text", F.when(usable, F.col("text")).otherwise(""))
        encoded = encoded.withColumn("payload", self.encode(F.col("text"))).drop("text")
        return encoded.withColumn("n_tok", F.size("payload").cast("long"))

    def sizes(self, docs: DataFrame) -> DataFrame:
        return docs.select("source", "doc_id", "n_tok")

    def for_python(self, payload: Column) -> Column:
        return payload

    def reader(self) -> Callable[[object], np.ndarray]:
        def read(payload: object) -> np.ndarray:
            return np.asarray(payload, dtype=np.int32)

        return read

    def pieces(self, payload: Column, blocks: Column, cut: Callable) -> Column:
        def piece(block: Column) -> Column:
            begin, length, closes = cut(block)
            ids = F.slice(payload, begin + 1, length)
            if self.eos_id is not None:
                ids = F.when(closes, append_eos(ids, self.eos_id)).otherwise(ids)
            return F.struct(block.alias("block_id"), ids.alias("piece"))

        return F.transform(blocks, piece)

    def assemble(self, pieces: Column) -> Column:
        return F.flatten(pieces)


# Bytes of text whose words are held at a time; a longer text is taken alone.
_TEXT_AT_ONCE = 1 << 22


def _text_slices(batch: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of bounded size; an empty batch as it is."""
    sizes = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False)
    ends, first = np.cumsum(sizes, dtype=np.int64), 0
    while first < len(batch):
        begin = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, begin + _TEXT_AT_ONCE, "right")))
        yield batch.slice(first, last - first)
        first = last
    if not len(batch):
        yield batch


def _word_ids(texts: pa.Array, words: pa.Array) -> pa.Array:
    split = pc.split_pattern_regex(texts.cast(pa.large_string()), WORD_SPLIT)
    parts = split.flatten()
    kept = pc.not_equal(parts, "")
    found = pc.index_in(parts.filter(kept), words)
    ids = pc.fill_null(pc.add(found, 1), 0).cast(pa.int32())
    # Words per row, once the empty strings at its ends are gone.
    rows = pc.list_parent_indices(split).filter(kept).to_numpy()
    ends = np.cumsum(np.bincount(rows, minlength=len(texts)))
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), ids)


class WordTokenizer(_ArrayTokenizer):
    """White-space words looked up in a vocabulary of bounded size.

    ``words`` is in id order, see ``operators.vocabulary``. Id 0 stands for
    unknown words, end-of-text is the id past the last word. A join of exploded
    words would have to shuffle every word back to its document; the lookup in
    Arrow batches moves nothing.
    """

    def __init__(self, spark: SparkSession, words: list[str], eos: bool = True):
        self.name = "word:" + hashlib.sha256("\n".join(words).encode()).hexdigest()
        self.unknown_id = 0
        self.vocab_size = len(words) + 2
        self.eos_id = len(words) + 1 if eos else None
        self._words = spark.sparkContext.broadcast(words)

    def encode(self, text: Column) -> Column:
        shared = self._words

        @F.arrow_udf("array<int>")
        def lookup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            words = pa.array(shared.value, pa.large_string())
            for batch in batches:
                # One array for a batch; what lies between text and ids is held for a part of it.
                yield pa.concat_arrays([_word_ids(part, words) for part in _text_slices(batch)])

        return lookup(text)


class JoinedWordTokenizer(_ArrayTokenizer):
    """The same over a vocabulary too large for a broadcast: words meet their ids in a join.

    ``vocab`` has ``word`` and ``id``. Works on whole tables only, through
    ``tokenize``. Ids follow the words' counts: the first ``HEAVY`` of them, which make up
    most of any text, are broadcast and found where the text is read; the other words
    travel to their ids, and with them the key of their document.
    """

    HEAVY = 1 << 16

    def __init__(self, vocab: DataFrame, size: int, eos: bool = True):
        digest = vocab.agg(F.bit_xor(F.xxhash64("word", "id"))).first()[0]
        self.name = f"joined-word:{size}:{digest}"
        self.unknown_id = 0
        self.vocab_size = size + 2
        self.eos_id = size + 1 if eos else None
        self._vocab = vocab.select("word", "id")

    def tokenize(self, docs: DataFrame) -> DataFrame:
        key = ["source", "doc_id", "body"]
        others = [c for c in docs.columns if c not in ("source", "doc_id", "text")]
        docs = docs.withColumn("body", F.xxhash64("text"))
        words = F.filter(F.split("text", WORD_SPLIT), lambda w: w != "")
        # Equal documents would otherwise pour their words into one list.
        each = docs.dropDuplicates(key).select(*key, F.posexplode(words).alias("pos", "word"))
        heavy = self._vocab.filter(F.col("id") <= self.HEAVY).select("word", F.col("id").alias("heavy"))
        each = each.join(F.broadcast(heavy), "word", "left")
        rare = each.filter(F.col("heavy").isNull()).join(
            self._vocab.filter(F.col("id") > self.HEAVY), "word", "left"
        )
        found = each.filter(F.col("heavy").isNotNull()).select(*key, "pos", F.col("heavy").alias("id")).unionByName(
            rare.select(*key, "pos", F.coalesce("id", F.lit(0)).alias("id"))
        )
        ids = found.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("w"))
        ids = ids.select(*[F.col(k).alias(f"of_{k}") for k in key], F.transform("w", lambda x: x["id"]).alias("w"))
        same = F.lit(True)
        for k in key:
            same = same & F.col(k).eqNullSafe(F.col(f"of_{k}"))
        payload = F.coalesce("w", F.array().cast("array<int>"))
        return docs.join(ids, same, "left").select(
            "source", "doc_id", *others, payload.alias("payload"), F.size(payload).cast("long").alias("n_tok")
        )


class FileTokenizer(_ArrayTokenizer):
    """Any ``tokenizer.json`` definition, such as a trained BPE model."""

    def __init__(self, spark: SparkSession, definition: str, eos_token: str | None = None):
        from tokenizers import Tokenizer

        model = Tokenizer.from_str(definition)
        self.name = "file:" + hashlib.sha256(definition.encode()).hexdigest()
        self.vocab_size = model.get_vocab_size()
        self.eos_id = model.token_to_id(eos_token) if eos_token else None
        if eos_token and self.eos_id is None:
            raise ValueError(f"{eos_token!r} is not in the vocabulary")
        self._definition = spark.sparkContext.broadcast(definition)

    @classmethod
    def load(cls, spark: SparkSession, path: str, eos_token: str | None = None) -> FileTokenizer:
        """Read the definition from any file system that Spark can reach."""
        return cls(spark, spark.read.text(path, wholetext=True).first()[0], eos_token)

    def encode(self, text: Column) -> Column:
        shared = self._definition

        @F.arrow_udf("array<int>")
        def lookup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            import os

            # Tasks already use all cores.
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            model = Tokenizer.from_str(shared.value)
            for batch in batches:
                found = model.encode_batch(batch.to_pylist(), add_special_tokens=False)
                yield pa.array([e.ids for e in found], pa.list_(pa.int32()))

        return lookup(text)
