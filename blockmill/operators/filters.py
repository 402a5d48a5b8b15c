"""Filters and guards on documents, packed rows and progress logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from blockmill.config import IGNORE_LABEL


def valid_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """Drop rows without text. Text of white space only is kept."""
    return docs.filter(F.col(text).isNotNull() & (F.col(text) != ""))


def nonempty_ids(rows: DataFrame, ids: str = "ids") -> DataFrame:
    """Drop documents that gave no tokens; use before adding end-of-text."""
    return rows.filter(F.size(ids) > 0)


def exact_length(rows: DataFrame, seq_len: int, observation=None) -> DataFrame:
    """Keep rows of exactly ``seq_len`` ids, counting the others if asked to."""
    fits = F.size("input_ids") == seq_len
    if observation is not None:
        rows = rows.observe(
            observation,
            F.count("*").alias("rows_read"),
            F.count_if(~F.coalesce(fits, F.lit(False))).alias("rows_skipped"),
        )
    return rows.filter(fits)


def out_of_range(ids: Column, vocab_size: int) -> Column:
    """Whether an id array holds an id that the vocabulary does not have."""
    return (F.array_min(ids) < 0) | (F.array_max(ids) >= vocab_size)


def _all_pass(rows: DataFrame, bad: Column, message: Column) -> DataFrame:
    """All rows, or a failing job at one that is bad. Column pruning keeps filters."""
    return rows.filter(F.coalesce(F.when(bad, F.raise_error(message).cast("boolean")), F.lit(True)))


def token_range_guard(rows: DataFrame, vocab_size: int, ids: str = "input_ids") -> DataFrame:
    """Pass rows through, failing the job at the first id outside the vocabulary.

    Takes packed rows and batches (arrays of id arrays). The check is a filter, so
    it also holds where the ids themselves are not used.
    """
    if dict(rows.dtypes)[ids].startswith("array<array"):
        low = F.array_min(F.transform(ids, lambda row: F.array_min(row)))
        high = F.array_max(F.transform(ids, lambda row: F.array_max(row)))
    else:
        low, high = F.array_min(ids), F.array_max(ids)
    message = F.concat(
        F.lit(f"token id out of range for vocabulary of {vocab_size}: min "),
        low.cast("string"), F.lit(", max "), high.cast("string"),
    )
    return _all_pass(rows, (low < 0) | (high >= vocab_size), message)


def n_supervised(labels: Column, ignore: int = IGNORE_LABEL) -> Column:
    """Number of labels that count for the loss."""
    return F.size(F.filter(labels, lambda x: x != F.lit(ignore).cast("long")))


def supervised_batches(
    batches: DataFrame, column: str = "labels", ignored: int | None = IGNORE_LABEL
) -> DataFrame:
    """Drop batches in which every label is ignored.

    ``column`` holds an array of arrays: labels, or ids with the padding id as the
    ignored one, which says the same before labels are made. ``ignored=None``
    drops only batches without any token.
    """
    if ignored is None:
        return batches.filter(F.exists(column, lambda row: F.size(row) > 0))
    return batches.filter(
        F.exists(column, lambda row: F.exists(row, lambda x: x != F.lit(ignored)))
    )


def not_finite(value: Column) -> Column:
    return F.isnan(value) | (F.abs(value) == F.lit(float("inf")))


def finite_guard(log: DataFrame, loss: str = "loss") -> DataFrame:
    """Pass a progress log through, failing the job at a NaN or infinite loss.

    A filter too: it holds whichever columns are used.
    """
    message = F.concat(
        F.lit("loss is not finite at opt_step "), F.col("opt_step").cast("string"),
        F.lit(", micro_step "), F.col("micro_step").cast("string"),
    )
    return _all_pass(log, not_finite(F.col(loss)), message)


def every_n(log: DataFrame, n: int, step: str = "opt_step") -> DataFrame:
    """Every n-th step, as for log lines and checkpoints."""
    return log.filter(F.col(step) % n == 0)
