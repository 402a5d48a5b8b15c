"""Exact running sums over a whole table without a one-task sort.

Rows carry a bucket number that grows with their order. Sums inside a bucket
come from a window partitioned by it; the sums of all buckets before come from
a table of bucket totals, which has a bounded number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from blockmill.session import MAX_BROADCAST_ROWS

# Buckets are numbered 0 .. MAX_BUCKETS - 1, so their totals fit a broadcast.
MAX_BUCKETS = MAX_BROADCAST_ROWS


def unit_bucket(u: Column, n_buckets: int) -> Column:
    """Bucket of a number in [0, 1)."""
    if n_buckets > MAX_BUCKETS:
        raise ValueError(f"{n_buckets} buckets are more than {MAX_BUCKETS}")
    n = max(1, n_buckets)
    return F.least(F.floor(u * F.lit(float(n))), F.lit(n - 1)).cast("int")


def bucket_starts(rows: DataFrame, bucket: str, value: Column) -> DataFrame:
    """For every bucket the sum of ``value`` over all earlier buckets."""
    totals = rows.groupBy(bucket).agg(F.sum(value).cast("long").alias("bucket_sum"))
    # At most MAX_BUCKETS aggregated rows meet in this window, whatever the data.
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        bucket,
        "bucket_sum",
        F.coalesce(F.sum("bucket_sum").over(before), F.lit(0)).cast("long").alias("bucket_start"),
    )


def running_start(
    rows: DataFrame,
    bucket: str,
    order: Sequence[str | Column],
    value: Column,
    out: str,
    starts: DataFrame | None = None,
) -> DataFrame:
    """Add the sum of ``value`` over all rows before this one in the total order.

    ``order`` must refine the order of the buckets. ``starts`` may be given when
    the bucket table is known already.
    """
    if starts is None:
        starts = bucket_starts(rows, bucket, value)
    inside = Window.partitionBy(bucket).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.join(F.broadcast(starts.select(bucket, "bucket_start")), bucket)
        .withColumn(out, (F.col("bucket_start") + F.sum(value).over(upto) - value).cast("long"))
        .drop("bucket_start")
    )


def running_start_by_group(
    rows: DataFrame,
    group: str,
    part: Column,
    order: Sequence[str | Column],
    value: Column,
    out: str,
) -> DataFrame:
    """The same inside every group: the sum of ``value`` over its earlier rows.

    ``part`` grows with the order and splits a group of any size over many tasks.
    Rows without a group have no place in any order and are left out.
    """
    parted = rows.withColumn("_part", part).withColumn("_value", value)
    totals = parted.groupBy(group, "_part").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        group, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(group, "_part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        parted.withColumn("_upto", F.sum("_value").over(upto))
        .join(starts, [group, "_part"])
        .withColumn(out, (F.col("_start") + F.col("_upto") - F.col("_value")).cast("long"))
        .drop("_part", "_value", "_start", "_upto")
    )
