"""Rates and remaining time from a progress log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from blockmill.operators.blocks import whole_div

# Steps, or seconds, of one run that share a task; longer runs are split.
_STEPS_PER_PART = 1 << 17
_SECONDS_PER_PART = 1 << 17


def progress_rates(
    log: DataFrame, tokens_per_micro: int, num_steps: int, log_every: int, run: str = "run",
    starts: DataFrame | None = None,
) -> DataFrame:
    """Tokens per second since the line before, and hours to the last step.

    Counts one process, as the log does. Lines without a run are left out.
    ``starts`` (run, ts and, for a run that goes on, micro_step) tells when processes
    began: a line is then measured from the latest line or start before it, so the first
    line of a run has a rate, and the time that a run stood still is not counted.
    Without a start a first line has no rate.

    A run of any length is split, by step or by time; what comes before the first row of
    a part comes from a table with one row per part.
    """
    if starts is None:
        rows = log.withColumn("_part", whole_div(F.col("opt_step").cast("long"), _STEPS_PER_PART))
        rows = rows.withColumn("_line", F.lit(1))
        order = F.struct("opt_step")
    else:
        began = [F.col(run), F.col("ts"), F.lit(0).alias("_line")]
        resumed = F.col("micro_step") if "micro_step" in starts.columns else F.lit(None)
        marks = starts.select(*began, F.coalesce(resumed.cast("long"), F.lit(0)).alias("micro_step"))
        rows = log.withColumn("_line", F.lit(1)).unionByName(marks, allowMissingColumns=True)
        second = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).cast("long")
        rows = rows.withColumn("_part", whole_div(second, _SECONDS_PER_PART))
        order = F.struct("ts", "_line", "opt_step")
    rows = rows.withColumn("_order", order)
    here = F.struct("ts", "micro_step")
    by_part = Window.partitionBy(run).orderBy("_part")
    ends = (
        rows.groupBy(run, "_part").agg(F.max_by(here, "_order").alias("_end"))
        .select(run, "_part", F.lag("_end").over(by_part).alias("_carried"))
    )
    inside = Window.partitionBy(run, "_part").orderBy("_order")
    before = F.coalesce(F.col("_lag"), F.col("_carried"))
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    earlier = F.unix_micros(F.col("_before.ts").cast("timestamp")) / 1e6
    dt = F.col("dt")
    return (
        rows.withColumn("_lag", F.lag(here).over(inside))
        .join(ends, [run, "_part"])
        .filter(F.col("_line") == 1)
        .withColumn("_before", before)
        .withColumn("dt", seconds - earlier)
        .withColumn(
            "tokens",
            (F.col("micro_step") - F.col("_before.micro_step")) * F.lit(tokens_per_micro).cast("long"),
        )
        .withColumn("tok_per_sec", F.col("tokens") / F.greatest(dt, F.lit(1e-9)))
        .withColumn(
            "eta_hours",
            (F.lit(num_steps) - F.col("opt_step")) * (dt / F.lit(float(max(log_every, 1e-9)))) / 3600.0,
        )
        .drop("_part", "_line", "_order", "_lag", "_carried", "_before")
    )
