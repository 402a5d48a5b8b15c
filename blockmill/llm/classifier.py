"""Quality classifier: subword embeddings learned with the labels.

A text is the mean of learned vectors, one for each of its features: words, character
n-grams inside word marks, and pairs of neighbouring words, all hashed into one table; a pair
of equal words is one feature of its own. A softmax over two classes stands on the mean.
Vectors and softmax are trained together by stochastic gradient descent in numpy.

Training takes a bounded sample of the labelled rows: at most ``max_rows`` rows in the order of a
seeded hash of ``doc_id``, and of these as many texts as fit ``max_bytes``. A text longer than
1/128 of that gives pieces from end to end, so it costs no more than its own place. That is
all that reaches the driver. Scoring needs one number for each feature (its vector times
the difference of the two softmax rows), so tasks get a table of fixed size, 1 MB
at 18 bits, and score whole texts of any length in one pass without a shuffle.

The score is the probability of label 1. Null text: as empty, which has no features and gets
the score of the bias, the share of label 1 as the softmax has it. Without labelled rows every
score is 0.5. Labels other than 0 and 1 and rows without a ``doc_id`` are not learned from. Repeated
rows give repeated results. Further columns are not read: ids and labels choose the training
rows and are never features. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from blockmill.llm.texts import WordTable, map_rows, utf8

_SHARE, _PIECES = 128, 16  # of ``max_bytes`` for one text; of a text that is longer
_UNIT = 1 << 24  # sums of scores are kept as whole numbers of 2^-24
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class ClassifierSettings:
    bits: int = 18
    dim: int = 8
    shortest: int = 3
    longest: int = 4
    epochs: int = 8
    rate: float = 0.5
    max_rows: int = 6000
    max_bytes: int = 24_000_000
    seed: int = 1234
    cached_words: int = 400_000


def word_features(word: bytes, settings: ClassifierSettings) -> list[int]:
    """The word and its character n-grams with ``<`` and ``>`` at its ends."""
    import xxhash

    mask, hash32 = (1 << settings.bits) - 1, xxhash.xxh32_intdigest
    marked = "<" + word.decode("utf-8") + ">"
    found = [hash32(word, 1) & mask]
    for size in range(settings.shortest, settings.longest + 1):
        found += [hash32(marked[k: k + size], 2) & mask for k in range(len(marked) - size + 1)]
    return found


def pair_features(keys: np.ndarray, settings: ClassifierSettings) -> np.ndarray:
    """Features of neighbouring words, from one 64-bit key for each word."""
    mixed = (keys[:-1] * _FACTOR) ^ keys[1:]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _FACTOR
    pairs = (mixed >> np.uint64(64 - settings.bits)).astype(np.int64)
    pairs[keys[:-1] == keys[1:]] = 0
    return pairs


@dataclass(frozen=True)
class Model:
    """Score of each feature (log odds it adds, before the mean) and the bias."""

    scores: np.ndarray
    bias: float


def _keys(words: list[bytes]) -> np.ndarray:
    import xxhash

    known = {w: xxhash.xxh64_intdigest(w) for w in set(words)}
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def text_features(words: list[bytes], settings: ClassifierSettings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text and the share of each."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    by_word = {w: word_features(w, settings) for w in set(words)}
    single = np.fromiter(chain.from_iterable(map(by_word.__getitem__, words)), np.int64)
    every = np.concatenate([single, pair_features(_keys(words), settings)])
    distinct, counts = np.unique(every, return_counts=True)
    return distinct, (counts / len(every)).astype(np.float32)


def train(texts: list[str], labels: list[int], settings: ClassifierSettings) -> Model:
    """Gradient descent, text by text in seeded order, with a rate that falls to zero."""
    size, dim = 1 << settings.bits, settings.dim
    if not texts:
        return Model(np.zeros(size, np.float32), 0.0)
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (size, dim)).astype(np.float32)
    softmax, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    share = (sum(labels) + 1) / (len(labels) + 2)
    bias[:] = np.log([1 - share, share])
    rows = [text_features(utf8(t).split(), settings) for t in texts]
    steps, done = settings.epochs * len(rows), 0
    for _ in range(settings.epochs):
        for k in rng.permutation(len(rows)).tolist():
            features, weights = rows[k]
            rate = settings.rate * (1 - done / steps)
            done += 1
            if not len(features):
                continue
            hidden = weights @ vectors[features]
            logits = softmax @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back = p @ softmax
            softmax -= rate * np.outer(p, hidden)
            # Each feature moves by its share, scaled so that the mean moves by ``rate * back``.
            vectors[features] -= rate * np.outer(weights / (weights @ weights), back)
    return Model((vectors @ (softmax[1] - softmax[0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    """Documents that are kept out of training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def spread_pieces(text: Column, most: int) -> Column:
    """Texts of more than ``most`` bytes as pieces at even steps, together within ``most`` bytes."""
    width = max(1, most // (4 * _PIECES) - 1)  # a code point has four bytes at most
    step = (F.length(text) - width) / (_PIECES - 1)
    pieces = [text.substr(F.floor(step * k).cast("int") + 1, F.lit(width)) for k in range(_PIECES)]
    return F.when(F.octet_length(text) > most, F.concat_ws(" ", *pieces)).otherwise(text)


def training_sample(docs: DataFrame, labels: DataFrame, settings: ClassifierSettings) -> list[tuple[str, int]]:
    """At most ``max_rows`` texts with labels, of at most ``max_bytes`` together.

    Of clashing labels for one id the largest counts.
    """
    draw = F.xxhash64(F.lit(settings.seed), "doc_id")
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    drawn = usable.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(draw, "doc_id").limit(settings.max_rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Both sides of the broadcast and of the window hold at most max_rows rows.
    # Of several texts under one id that with the least hash is taken, whatever the partitioning.
    found = texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "quality").agg(
        F.min_by("text", F.xxhash64("text")).alias("text")
    ).withColumn(
        "text", spread_pieces(F.col("text"), settings.max_bytes // _SHARE)
    ).withColumn("size", F.octet_length("text"))
    upto = Window.orderBy(draw, "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fit = found.withColumn("upto", F.sum("size").over(upto)).filter(F.col("upto") <= settings.max_bytes)
    rows = fit.select("doc_id", "text", "quality").collect()
    return [(r[1], r[2]) for r in sorted(rows)]


def score_documents(docs: DataFrame, model: Model, settings: ClassifierSettings, threshold: float) -> DataFrame:
    """``doc_id, score, predicted`` of every row of ``doc_id, text``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.scores, model.bias))

    def make():
        import xxhash

        scores, bias = shared.value

        def summed(words):
            each = [word_features(w, settings) for w in words]
            sizes = np.fromiter(map(len, each), np.int64, len(each))
            values = scores[np.fromiter(chain.from_iterable(each), np.int64, int(sizes.sum()))].astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            sums = np.rint(np.add.reduceat(values, starts) * _UNIT).astype(np.int64)
            keys = [xxhash.xxh64_intdigest(w) for w in words]
            keys = [k - (1 << 64) if k >> 63 else k for k in keys]
            return list(zip(sums.tolist(), sizes.tolist(), keys))

        table = WordTable(summed, settings.cached_words)

        def score(words):
            if not words:
                return 1 / (1 + np.exp(-bias))
            values = table.values(table.numbers(words))[0].reshape(-1, 3)
            pairs = pair_features(np.ascontiguousarray(values[:, 2]).view(np.uint64), settings)
            total = values[:, 0].sum() / _UNIT + scores[pairs].sum(dtype=np.float64)
            return 1 / (1 + np.exp(-(total / (values[:, 1].sum() + len(pairs)) + bias)))

        def rows(doc_ids, texts):
            found = [utf8(t).split() for t in texts]
            table.learn(found)
            for doc_id, words in zip(doc_ids, found):
                p = float(score(words))
                yield doc_id, p, int(p >= threshold)

        return rows

    return map_rows(docs, ["doc_id", "text"], "doc_id long, score double, predicted int", make)


def classify(
    docs: DataFrame, labels: DataFrame, settings: ClassifierSettings = ClassifierSettings(), threshold: float = 0.3
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, by a model learned from ``labels``."""
    sample = training_sample(docs, labels, settings)
    model = train([t for t, _ in sample], [q for _, q in sample], settings)
    scored = score_documents(docs, model, settings, threshold)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
