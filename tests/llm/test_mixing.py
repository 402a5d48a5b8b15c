import duckdb
import pytest
from pyspark.sql import functions as F

from blockmill.llm import mixing as M
from blockmill.llm.mixing_sql import mix_sql
from llm_cases import DOCS, comparable, edge_rows, prose

DOMAINS, LANGS, SOURCES = {"a": 3, "b": 1}, {"en": 2, "de": 1}, {"s0": 1, "s1": 2, "s2": 5, "s3": 1}


def fill(children, budget):
    """Shares of children (weight, capacity): the common level, by bisection."""
    if sum(c for w, c in children if w) <= budget:
        return [c if w else 0 for w, c in children]
    low, high = 0.0, float(budget) + 1
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(c, w * level) for w, c in children) < budget else (low, level)
    return [min(c, w * low) for w, c in children]


def documents():
    rows = []
    for k in range(240):
        source, lang = f"s{k % 4}", ("en", "de", "fr")[k % 3]
        rows.append((k, prose(k, 5 + 7 * (k % 11)), lang, source, 0))
    return rows


def plan(**more):
    domain = F.when(F.col("source").isin("s0", "s1"), "a").otherwise("b")
    return M.MixPlan(domain, DOMAINS, LANGS, SOURCES, **more)


@pytest.mark.parametrize("percent,epochs", [(30, 1), (80, 2), (150, 3), (100, 1), (1000, 2), (0, 1)])
def test_equals_sql(spark, percent, epochs):
    df = spark.createDataFrame(documents(), DOCS).repartition(6)
    got = M.select_mix(df, plan(budget_percent=percent, max_epochs=epochs)).select(
        "doc_id", "__domain", "lang", "source", "__epoch", "__tokens", "__taken")
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", documents())
    domain = "CASE WHEN source IN ('s0', 's1') THEN 'a' ELSE 'b' END"
    want = con.sql(mix_sql(domain, DOMAINS, LANGS, SOURCES, percent, epochs, 1234)).fetchall()
    assert comparable(got.collect()) == comparable(want)
    total = sum(len(r[1].encode()) for r in documents())
    given = sum(w[6] for w in want)
    assert min(total * epochs, total * percent // 100) - 40 <= given <= total * percent // 100


def test_budgets_follow_the_tree(spark):
    rows = documents()
    df = spark.createDataFrame(rows, DOCS)
    chosen = plan(budget_percent=90, max_epochs=2)
    got = {tuple(r[:3]): r["__give"] for r in M.leaf_budgets(df, chosen).collect()}
    supply = {}
    for _, text, lang, source, _ in rows:
        leaf = ("a" if source in ("s0", "s1") else "b", lang, source)
        supply[leaf] = supply.get(leaf, 0) + 2 * len(text.encode())

    def below(prefix):
        return sum(c for leaf, c in supply.items() if leaf[: len(prefix)] == prefix)

    total = sum(supply.values()) // 2 * 90 // 100
    want, work = {}, [((), total)]
    weights = [DOMAINS, LANGS, SOURCES]
    while work:
        prefix, budget = work.pop()
        if len(prefix) == 3:
            want[prefix] = budget
            continue
        names = sorted({leaf[len(prefix)] for leaf in supply if leaf[: len(prefix)] == prefix})
        shares = fill([(weights[len(prefix)].get(n, 1), below((*prefix, n))) for n in names], budget)
        work += [((*prefix, n), s) for n, s in zip(names, shares)]
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) <= 3 for k in want)


def test_weight_zero_and_other_limits(spark):
    df = spark.createDataFrame(documents(), DOCS)
    domain = F.lit("only")
    got = M.select_mix(df, M.MixPlan(domain, source_weights={"s1": 0}, budget_percent=300, max_epochs=3)).collect()
    assert {r["source"] for r in got} == {"s0", "s2", "s3"}
    assert {r["__epoch"] for r in got} == {0, 1, 2}
    with pytest.raises(ValueError):
        M.MixPlan(domain, default_weight=-1)
    other = M.select_mix(df, plan(budget_percent=40, seed=5)).select("doc_id").collect()
    assert comparable(other) != comparable(M.select_mix(df, plan(budget_percent=40)).select("doc_id").collect())


def test_edge_rows(edges, nothing):
    chosen = M.MixPlan(F.lit("x"), budget_percent=100, max_epochs=1)
    got = M.mixed_documents(edges, chosen)
    assert got.columns == edges.columns
    assert comparable(r[:2] for r in got.collect()) == comparable(r[:2] for r in edge_rows() if r[1])
    assert M.mixed_documents(nothing, chosen).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(documents(), DOCS)
    text = M.select_mix(df, plan(budget_percent=70))._jdf.queryExecution().toString()
    assert "Python" not in text and "MapInArrow" not in text and "CartesianProduct" not in text


def test_columns_named_like_working_ones(spark, edges):
    names = "__tokens __epoch __whole __u __domain own__u __give".split()
    frame = edges.withColumns({n: F.col("source") for n in names})
    plan = M.MixPlan(F.lit("a"), DOMAINS, LANGS, SOURCES, budget_percent=100, max_epochs=2, seed=3)
    plain = M.mixed_documents(edges, plan)
    got = M.mixed_documents(frame, plan)
    assert got.columns == frame.columns
    assert comparable(got.select(plain.columns).collect()) == comparable(plain.collect())
    assert got.filter(" or ".join(f"not ({n} <=> source)" for n in names)).count() == 0
