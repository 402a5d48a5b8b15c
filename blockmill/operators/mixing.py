"""Which document comes next: weighted sampling as one arithmetic projection.

Instead of drawing a source again and again, each record gets an arrival time
``(epoch + u) * n / w`` from a seeded hash ``u``, the record count ``n`` and the
weight ``w`` of its source. Sources then arrive at rates in proportion to their
weights, and taking a source out leaves the pace of the others untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from blockmill.config import SourceSpec
from blockmill.functions.hashing import unit_hash
from blockmill.operators.prefix import running_start, running_start_by_group, unit_bucket

# Total order of the mix. Ties of the arrival time are broken by the other keys;
# the token count parts documents that share an id against the rules.
ORDER = ("arrival", "source", "epoch", "doc_id", "n_tok")


def attach_spec(docs: DataFrame, specs: DataFrame) -> DataFrame:
    """Settings of its source on every document; unlisted sources drop out.

    ``specs`` comes from ``sources.source_specs``, which bounds its size.
    """
    wanted = specs.select(F.col("name").alias("source"), "weight", "token_cap")
    return docs.join(F.broadcast(wanted), "source")


def source_stats(sizes: DataFrame, eos: bool = True) -> DataFrame:
    """Records, documents and tokens per source; end-of-text counts as a token.

    ``sizes`` has one row per record with its token count, 0 for unusable ones.
    """
    length = F.when(F.col("n_tok") > 0, F.col("n_tok") + int(eos)).otherwise(0)
    return sizes.groupBy("source").agg(
        F.count("*").alias("n_records"),
        F.count_if(F.col("n_tok") > 0).alias("n_docs"),
        F.sum(length).cast("long").alias("tokens"),
        F.max(length).cast("long").alias("longest"),
    ).withColumn("mean_len", F.try_divide("tokens", "n_docs"))


def repeat_epochs(docs: DataFrame, epochs: Column) -> DataFrame:
    """Every record once per epoch, numbered from 0."""
    return docs.withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs.cast("int") - 1)))


def arrival_time(seed: int, n_records: Column, weight: Column) -> Column:
    """Position of a record in the race of the sources."""
    u = unit_hash(seed, F.col("source"), F.col("epoch"), F.col("doc_id"))
    return (F.col("epoch") + u) * n_records / weight


def weighted_interleave(
    docs: DataFrame, specs: DataFrame, stats: DataFrame, seed: int, epochs: int = 1
) -> DataFrame:
    """Add ``epoch`` and ``arrival`` to every record of the listed sources.

    ``stats`` holds the record counts before any filter, since a dropped record
    has used up its draw; it has one row per source of ``specs``.
    """
    paced = specs.filter(F.col("weight") > 0).join(
        stats.withColumnRenamed("source", "name"), "name"
    ).select(F.col("name").alias("source"), "weight", "n_records")
    raced = repeat_epochs(docs.join(F.broadcast(paced), "source"), F.lit(epochs))
    return raced.withColumn(
        "arrival", arrival_time(seed, F.col("n_records"), F.col("weight"))
    ).drop("weight", "n_records")


def seeded_shuffle(docs: DataFrame, seed: int, n_buckets: int = 4096) -> DataFrame:
    """A full permutation inside every source: key ``u`` and position ``pos``.

    A source of any size is spread over ``n_buckets`` ranges of the key.
    """
    keyed = docs.withColumn("u", unit_hash(seed, F.col("source"), F.lit(0), F.col("doc_id")))
    return running_start_by_group(
        keyed, "source", unit_bucket(F.col("u"), n_buckets), ["u", "doc_id"], F.lit(1), "pos"
    )


def weighted_choice(
    rows: DataFrame, specs: Sequence[SourceSpec], seed: int, keys: Sequence[str], out: str = "choice"
) -> DataFrame:
    """Choose one spec per row with probability in proportion to its weight.

    The first spec whose running weight reaches ``u * total`` wins, the last one
    if none does.
    """
    total = 0.0
    bounds = []
    for s in specs:
        total += s.weight
        bounds.append((s.name, total))
    draw = unit_hash(seed, *[F.col(k) for k in keys]) * F.lit(total)
    cases = F
    for name, bound in bounds:
        cases = cases.when(F.col("draw") <= F.lit(bound), F.lit(name))
    choice = cases.otherwise(F.lit(bounds[-1][0]))
    return rows.withColumn("draw", draw).withColumn(out, choice).drop("draw")


def stream_offsets(rows: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """Position ``off`` of every document in the rolling token stream.

    ``starts`` is the bucket table where it is known already.
    """
    return running_start(rows, "bucket", list(ORDER), F.col("len"), "off", starts)


def before_cut(arrival: str = "arrival") -> Column:
    """Whether a document of a capped source comes no later than its last one.

    Uses the columns ``cut_arrival``, ``cut_epoch``, ``cut_doc`` and ``cut_n_tok``,
    null where the source is never cut.
    """
    here, cut = F.col(arrival), F.col("cut_arrival")
    tie = F.struct("epoch", "doc_id", "n_tok") <= F.struct("cut_epoch", "cut_doc", "cut_n_tok")
    return cut.isNull() | (here < cut) | ((here == cut) & tie)
