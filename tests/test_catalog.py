"""Every registered query against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from catalog.oracle import ORACLE
from catalog.queries import QUERIES


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def comparable(rows):
    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 9)
        return v
    return sorted(([value(v) for v in r] for r in rows), key=repr)


def test_same_names():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    result = duck.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert comparable(got) == comparable(want)
    assert got or name in ("missing_shards",)


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.queries()) >= set(QUERIES)
    assert contract.oracle_sql().items() >= ORACLE.items()


def test_damage_keeps_one_shard_aside(spark, small, monkeypatch):
    from catalog import queries as Q

    kept, store = [], Q.stored
    monkeypatch.setattr(Q, "BLOCKS_PER_SHARD", 100)
    monkeypatch.setattr(Q, "stored", lambda df, label: kept.append(store(df, label)) or kept[-1])
    path = Q.damaged(spark, small)
    assert [df.count() for df in kept] == [100]
    shards = {r["shard_id"]: r["n"] for r in Q.scan_packed(spark, Q.shards_of(path)).groupBy("shard_id").agg(
        Q.F.count("*").alias("n")).collect()}
    assert max(k for k in shards if k != Q.STRAY_SHARD) == len(shards) - 2 > 2
    assert set(shards.values()) == {100}
