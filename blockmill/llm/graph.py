"""Connected components of a link table, by large-star and small-star rounds.

Every round is a few shuffles over links and ends in a table in the shared folder,
so neither links nor components ever meet on the driver, a lost executor costs
one round at most, and a node with very many links is only ever met in a minimum
(combined before the shuffle) or in a join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from blockmill.session import stored


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (
        both.filter("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every link runs from the larger to the smaller node already."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for all nodes of ``links(u, v)``; the root is the smallest node reachable.

    Links may come in either direction, more than once or from a node to itself;
    a node that has only a link to itself gets no row. No links, no rows.
    """
    now = stored(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    before, state = None, _state(now)
    while state != before:
        before = state
        now = stored(_small_star(_large_star(now)), "links")
        state = _state(now)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
