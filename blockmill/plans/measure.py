"""Tokens of the documents that a plan asks for, and of no others.

A budget usually ends a build long before its sources. Documents are read in the order
of a seeded key in [0, 1), so the first ones of a source are those below some *share*.
``TokenSlices`` tokenises a source up to a share and, when the plan turns out to need
more, from there to the next one. What a slice holds does not depend on how far
other slices go, so the plan is the same as one that measures everything.

A slice is chosen by key, wherever its documents lie, so making one scans the text
once; the tokenizer, which costs a hundred times as much, sees the slice alone.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from blockmill.functions.hashing import unit_hash
from blockmill.session import default_parallelism, exists, scratch_path, small_table

# Input that a core gets through well in one split.
SPLIT_BYTES = 128 << 20


def spread(rows: DataFrame, read: DataFrame | None = None) -> DataFrame:
    """Rows dealt over all cores where the input is too small to be split well.

    ``read`` is the table they are taken from, if not they themselves.

    A costly step over a file of one row group would otherwise run in one task. What
    is shuffled here is less than one split a core.
    """
    cores = default_parallelism(rows.sparkSession)
    table = rows if read is None else read
    if int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) >= cores * SPLIT_BYTES:
        return rows
    return rows.repartition(4 * cores, "source", "doc_id")


def content(*columns: str | Column) -> Column:
    """Sum of row hashes; unlike their parity it tells {A, A, B} from {C, C, B}."""
    return F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))


def record_keys(docs: DataFrame, sources: list[str]) -> dict[str, tuple[int, int]]:
    """Records of every source and the sum of their id hashes; reads no text."""
    rows = docs.filter(F.col("source").isin(*sources)).groupBy("source").agg(
        F.count("*").alias("n"), content("doc_id").alias("ids")
    )
    return {r["source"]: (r["n"], int(r["ids"])) for r in rows.collect()}


class TokenSlices:
    """Tokenised documents up to a share of every source.

    ``keep`` names a folder in which a second attempt finds the slices of the first.
    It takes one only if the texts still have the same hashes.
    """

    def __init__(self, docs: DataFrame, tokenizer, seed: int, sources: list[str], keep: str | None = None):
        self.docs = docs.select("source", "doc_id", "text").filter(F.col("source").isin(*sources))
        self.tokenizer, self.seed = tokenizer, seed
        self.shares = {name: 0.0 for name in sources}
        self._folder = keep or scratch_path(docs.sparkSession, "tokens")
        self._paths: list[str] = []

    @property
    def spark(self) -> SparkSession:
        return self.docs.sparkSession

    @property
    def rows(self) -> DataFrame:
        """All that is tokenised so far."""
        tables = [self.spark.read.parquet(p).drop("body") for p in self._paths]
        return reduce(DataFrame.unionByName, tables)

    def reach(self, shares: Mapping[str, float]) -> DataFrame:
        """Tokenise what is missing up to these shares; shares that are behind stay."""
        wanted = {s: min(1.0, max(have, shares.get(s, 0.0))) for s, have in self.shares.items()}
        if wanted != self.shares or not self._paths:
            self._add(wanted)
        return self.rows

    def _add(self, wanted: dict[str, float]) -> None:
        names = list(wanted)
        bounds = small_table(self.spark, {
            "source": pa.array(names, pa.string()),
            "begin": pa.array([self.shares[s] for s in names], pa.float64()),
            "end": pa.array([wanted[s] for s in names], pa.float64()),
        })
        key = unit_hash(self.seed, F.col("source"), F.lit(0), F.col("doc_id"))
        # The upper end of the last share takes in every key.
        inside = (key >= F.col("begin")) & ((key < F.col("end")) | (F.col("end") >= 1.0)) & (F.col("begin") < 1.0)
        part = self.docs.join(bounds, "source").filter(inside).select("source", "doc_id", "text")
        path = f"{self._folder}/slice={self._name(wanted)}"
        if not (exists(self.spark, f"{path}/_SUCCESS") and self._holds(path, part)):
            # The hash goes along as a further column of the documents.
            spread_rows = spread(part, self.docs).withColumn("body", F.xxhash64("text"))
            self.tokenizer.tokenize(spread_rows).write.mode("overwrite").parquet(path)
        self._paths.append(path)
        self.shares = wanted

    def _name(self, wanted: dict[str, float]) -> str:
        text = json.dumps([self.tokenizer.name, self.seed, self.shares, wanted], sort_keys=True)
        return hashlib.sha256(text.encode()).hexdigest()

    def _holds(self, path: str, part: DataFrame) -> bool:
        """Whether a stored slice has the very documents of now."""
        here = part.select("source", "doc_id", F.xxhash64("text").alias("body"))
        found = [
            t.agg(F.count("*"), content("source", "doc_id", "body")).first()
            for t in (self.spark.read.parquet(path), here)
        ]
        return found[0] == found[1]
