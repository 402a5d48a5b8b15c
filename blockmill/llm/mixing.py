"""Mixing sources to target weights: a budget handed down a domain, language, source tree.

Every node has a weight among its siblings. The token budget is divided at the root
by weight and so on down to the leaves. A leaf can give at most ``max_epochs`` times
its tokens, an inner node as much as its leaves together. What a node cannot use
goes to its siblings by their weights; only when all of them are full has their
parent less to give, and the shortage goes to the parent's siblings. Both follow
from one rule at each node: a common level x such that the children's
least(capacity, weight * x) sum to the node's budget.

A leaf takes whole epochs and then a prefix of one more. Every epoch has its own
seeded order; the document that crosses the end of the prefix gives only its first
tokens (``taken``).

Tokens are UTF-8 bytes. Null text and empty text have none and are never taken. A null
language or source is a value of its own. Rows with a null ``doc_id`` are ordered
by their text; repeated rows are taken one by one. Weights are whole numbers, 0 leaves
a node out. Budgets are rounded to whole tokens, so up to one token a node may stay
unused. An empty table gives an empty table.

DataFrame functions only. Nothing but leaf and bucket totals is shuffled, and the rows
of one bucket for each leaf; a source with a third of all rows has in proportion
more buckets. The plan has one row for each leaf and is broadcast if it has at most
2^20 rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from blockmill.functions.hashing import unit_hash
from blockmill.llm.texts import set_aside
from blockmill.session import broadcast_if_small, stored

ROWS_PER_BUCKET = 4096
TREE = ["__domain", "__lang", "__source"]


@dataclass(frozen=True)
class MixPlan:
    """Weights by node name (others get ``default_weight``) and the budget.

    The budget is ``budget_tokens``, or ``budget_percent`` of all tokens there are.
    """

    domain: Column
    domain_weights: Mapping[str, int] = field(default_factory=dict)
    lang_weights: Mapping[str, int] = field(default_factory=dict)
    source_weights: Mapping[str, int] = field(default_factory=dict)
    default_weight: int = 1
    budget_tokens: int | None = None
    budget_percent: int = 100
    max_epochs: int = 4
    seed: int = 1234

    def __post_init__(self):
        weights = [self.default_weight]
        for given in (self.domain_weights, self.lang_weights, self.source_weights):
            weights += given.values()
        if any(w != int(w) or w < 0 for w in weights):
            raise ValueError("weights are whole numbers of at least 0")
        if self.max_epochs < 1 or (self.budget_tokens or 0) < 0 or self.budget_percent < 0:
            raise ValueError("max_epochs >= 1, budget >= 0")


def _weight(name: Column, given: Mapping[str, int], default: int) -> Column:
    if not given:
        return F.lit(int(default)).cast("long")
    pairs = [F.lit(x) for k, v in given.items() for x in (k, int(v))]
    found = F.element_at(F.create_map(*pairs), F.coalesce(name, F.lit("")))
    return F.coalesce(F.when(name.isNotNull(), found), F.lit(int(default))).cast("long")


def divide(nodes: DataFrame, parent: list[str], name: str, weight: Column, out: str) -> DataFrame:
    """Add each node's share of its parent's ``__budget``, at most its ``__cap``.

    Children that fill up come first in order of cap / weight. With those before
    child k full, the level is (budget - their caps) / (weights from k on); the
    highest such level is the common one.
    """
    order = [F.col("__cap") / F.col("__w"), F.col(name).asc_nulls_first()]
    family = Window.partitionBy(*(parent or [F.lit(0)]))
    before = family.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = family.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("__budget") - F.coalesce(F.sum("__cap").over(before), F.lit(0))
    weights = F.sum("__w").over(onward)
    level = F.struct((left / weights).alias("x"), left.alias("left"), weights.alias("weights"))
    share = F.least("__cap", F.expr("__w * __top.left div __top.weights"))
    family_sum = F.sum("__cap").over(family)
    return (
        nodes.withColumn("__w", weight).filter("__w > 0")
        .withColumn("__level", level).withColumn("__top", F.max("__level").over(family))
        .withColumn("__all", family_sum)
        .withColumn(out, F.when(F.col("__all") <= F.col("__budget"), F.col("__cap")).otherwise(
            F.greatest(share, F.lit(0))).cast("long"))
        .drop("__w", "__level", "__top", "__all")
    )


def _same(a: str, b: str, columns: list[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return condition


def _tree_columns(docs: DataFrame, plan: MixPlan) -> DataFrame:
    """The rows with ``__domain``, ``__lang``, ``__source`` and ``__tokens``."""
    return docs.withColumns({
        "__domain": plan.domain, "__lang": F.col("lang"), "__source": F.col("source"),
        "__tokens": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"),
    })


def leaf_budgets(docs: DataFrame, plan: MixPlan) -> DataFrame:
    """One row for each leaf: ``__docs``, ``__supply`` and its budget ``__give``.

    Leaves under a weight of 0 are left out.
    """
    leaves = _tree_columns(docs, plan).groupBy(*TREE).agg(
        F.count(F.lit(1)).alias("__docs"), F.sum("__tokens").cast("long").alias("__supply")
    )
    leaves = stored(leaves, "mix-leaves")
    weights = {
        "__domain": _weight(F.col("__domain"), plan.domain_weights, plan.default_weight),
        "__lang": _weight(F.col("__lang"), plan.lang_weights, plan.default_weight),
        "__source": _weight(F.col("__source"), plan.source_weights, plan.default_weight),
    }
    usable = leaves.filter((weights["__domain"] > 0) & (weights["__lang"] > 0) & (weights["__source"] > 0))
    usable = usable.withColumn("__cap", F.col("__supply") * plan.max_epochs)
    total = F.lit(plan.budget_tokens).cast("long")
    if plan.budget_tokens is None:
        supply = leaves.agg(F.sum("__supply")).first()[0] or 0
        total = F.lit(supply * plan.budget_percent // 100).cast("long")
    given = None
    for depth, name in enumerate(TREE):
        keys, parent = TREE[: depth + 1], TREE[:depth]
        nodes = usable if depth == 2 else usable.groupBy(*keys).agg(F.sum("__cap").cast("long").alias("__cap"))
        if given is None:
            nodes = nodes.withColumn("__budget", total)
        else:
            nodes = nodes.alias("n").join(given.alias("p"), _same("n", "p", parent)).select("n.*", "p.__budget")
        given = divide(nodes, parent, name, weights[name], "__give")
        if depth < 2:
            given = given.select(*keys, F.col("__give").alias("__budget"))
    return given.select(*TREE, "__docs", "__supply", "__give").filter("__give > 0")


def _bucket_count() -> Column:
    return F.least(F.expr(f"__docs div {ROWS_PER_BUCKET}") + 1, F.lit(1 << 20)).cast("int")


def _placed(docs: DataFrame, leaves: DataFrame, rows: int, plan: MixPlan) -> DataFrame:
    """Rows beside their leaf's plan, with their place in the epoch that is cut."""
    joined = _tree_columns(docs, plan).alias("d").join(
        broadcast_if_small(leaves, rows).alias("l"), _same("d", "l", TREE)
    )
    extra = [c for c in leaves.columns if c not in TREE]
    joined = joined.select("d.*", *[f"l.{c}" for c in extra])
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    joined = joined.withColumn("__u", unit_hash(plan.seed, F.col("__whole"), name))
    bucket = F.least(F.floor(F.col("__u") * F.col("__buckets")), F.col("__buckets") - 1)
    return joined.withColumn("__bucket", bucket.cast("int"))


def select_mix(docs: DataFrame, plan: MixPlan) -> DataFrame:
    """The rows taken, with all their columns and ``__domain, __epoch, __tokens, __taken``."""
    budgets = leaf_budgets(docs, plan).withColumns({
        "__whole": F.expr("__give div __supply"), "__rest": F.expr("__give % __supply"),
        "__buckets": _bucket_count(),
    }).select(*TREE, "__whole", "__rest", "__buckets")
    budgets = stored(budgets, "mix-budgets")
    rows = budgets.count()
    sums = _placed(docs, budgets, rows, plan).groupBy(*TREE, "__bucket", "__rest").agg(
        F.sum("__tokens").cast("long").alias("__sum")
    )
    upto = Window.partitionBy(*TREE).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    crossed = (
        sums.withColumn("__end", F.sum("__sum").over(upto))
        .withColumn("__start", F.col("__end") - F.col("__sum"))
        .filter("__start < __rest and __rest <= __end")
        .select(*TREE, F.col("__bucket").alias("__cut"), F.col("__start").cast("long").alias("__cut_start"))
    )
    leaves = budgets.alias("b").join(crossed.alias("c"), _same("b", "c", TREE), "left")
    leaves = stored(leaves.select("b.*", "c.__cut", "c.__cut_start"), "mix-plan")
    placed = _placed(docs, leaves, rows, plan).filter("__tokens > 0")
    epochs = F.when(F.col("__whole") > 0, F.sequence(F.lit(0), (F.col("__whole") - 1).cast("int")))
    epochs = F.coalesce(epochs, F.array().cast("array<int>"))
    early = F.when(F.col("__bucket") < F.col("__cut"), F.array(F.col("__whole").cast("int")))
    epochs = F.concat(epochs, F.coalesce(early, F.array().cast("array<int>")))
    out = [*docs.columns, "__domain", "__epoch", "__tokens", "__taken"]
    whole = placed.withColumn("__epoch", F.explode(epochs)).withColumn("__taken", F.col("__tokens")).select(*out)
    inside = Window.partitionBy(*TREE).orderBy("__u", "doc_id", "__tokens")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        placed.filter(F.col("__bucket") == F.col("__cut"))
        .withColumn("__start", F.col("__cut_start") + F.sum("__tokens").over(inside) - F.col("__tokens"))
        .withColumn("__taken", F.least("__tokens", F.col("__rest") - F.col("__start")).cast("long"))
        .filter("__taken > 0").withColumn("__epoch", F.col("__whole").cast("int")).select(*out)
    )
    return whole.unionByName(cut)


def mixed_documents(docs: DataFrame, plan: MixPlan) -> DataFrame:
    """The rows taken, once for each epoch, with the columns of ``docs``; texts stay whole."""
    docs, back = set_aside(docs)
    return select_mix(docs, plan).select(*docs.columns).withColumnsRenamed(back)
