"""Word vocabulary: the most frequent words, numbered by frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from blockmill.functions.tokenizers import WORD_SPLIT, JoinedWordTokenizer, WordTokenizer
from blockmill.operators.prefix import MAX_BUCKETS, running_start
from blockmill.session import MAX_BROADCAST_ROWS, default_parallelism, stored

_WORDS_PER_RANGE = 1 << 18


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WORD_SPLIT), lambda w: w != "")


def build_vocab(docs: DataFrame, max_size: int | None, text: str = "text") -> DataFrame:
    """Words with count and id, ids from 1 by falling count, ties by the word.

    ``max_size`` is the caller's choice, None takes every word; rarer words become
    the unknown id when texts are encoded. All words are counted, into a stored
    table. A histogram of the counts then tells which words cannot be among the
    ``max_size`` first ones. Up to a bounded size one task ranks what is left;
    larger vocabularies are ranked range by range.
    """
    if max_size is not None and max_size < 1:
        raise ValueError("max_size must be at least 1")
    pieces = docs.select(F.explode(F.split(text, WORD_SPLIT)).alias("word"))
    counts = stored(
        pieces.filter(F.col("word") != "").groupBy("word").agg(F.count("*").alias("count")),
        "word-counts",
    )
    # Classes of about nine percent; a 64-bit count has at most 504 of them.
    count_class = F.floor(F.log2("count") * 8).cast("int")
    classes = counts.groupBy(count_class.alias("class")).agg(F.count("*").alias("n")).collect()
    seen, lowest = 0, 0
    for row in sorted(classes, key=lambda r: -r["class"]):
        seen, lowest = seen + row["n"], row["class"]
        if max_size is not None and seen >= max_size:
            break
    order = (F.desc("count"), F.asc("word"))
    if max_size is not None and max_size <= MAX_BROADCAST_ROWS:
        kept = counts.filter(count_class >= lowest).orderBy(*order).limit(max_size)
        return kept.withColumn("id", F.row_number().over(Window.orderBy(*order)))
    ranked = _ranked(counts, count_class >= lowest)
    return ranked if max_size is None else ranked.filter(F.col("id") <= max_size)


def _ranked(counts: DataFrame, wanted: Column) -> DataFrame:
    """Ids of any number of words: ranges of the whole order, then places in a range.

    Spark samples whole rows for the bounds, so words that begin alike or are equally rare
    spread as all others do. The ranges are written, and their sizes give each its start.
    """
    spark = counts.sparkSession
    kept = counts.filter(wanted)
    parts = max(default_parallelism(spark), -(-kept.count() // _WORDS_PER_RANGE))
    order = (F.desc("count"), F.asc("word"))
    ranged = kept.repartitionByRange(min(parts, MAX_BUCKETS), *order)
    ranged = stored(ranged.withColumn("range", F.spark_partition_id()), "word-ranges")
    placed = running_start(ranged, "range", list(order), F.lit(1), "place")
    return placed.select("word", "count", (F.col("place") + 1).cast("int").alias("id"))


def word_tokenizer(vocab: DataFrame, eos: bool = True) -> WordTokenizer | JoinedWordTokenizer:
    """A tokenizer over a vocabulary of ``build_vocab``.

    Vocabularies past the broadcast bound are joined to the words of the texts.
    """
    spark: SparkSession = vocab.sparkSession
    vocab = stored(vocab, "vocabulary")
    size = vocab.count()
    if size > MAX_BROADCAST_ROWS:
        return JoinedWordTokenizer(vocab, size, eos)
    words = [r["word"] for r in vocab.select("id", "word").orderBy("id").collect()]
    return WordTokenizer(spark, words, eos)
