import math

import numpy as np
import pytest

from blockmill.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, id long, x int, n int, part int"


def rows_of(vectors, ids=None):
    ids = ids or range(len(vectors))
    return [(i, v, 1, 7, 7, 7, 7) for i, v in zip(ids, vectors)]


def brute(vectors):
    """Whitened rows by exact whole numbers and a library's eigenvectors."""
    x = [[math.floor(256 * float(np.float32(c))) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit) - np.array(sums) / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    whitened = (np.array(x) - np.array(sums) / n) @ axes / np.sqrt(values)
    return n, deviations, whitened, values / np.trace(v)


def random_vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    spread = rng.normal(size=(d, d)) / d
    return (rng.normal(size=(n, d)) @ spread + rng.normal(size=d)).astype(np.float32).tolist()


def check(got, vectors, ids):
    n, deviations, whitened, explained = brute(vectors)
    found = {}
    for r in got:
        found.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    k = len(explained)
    assert len(got) == len(vectors) * k and {r["n"] for r in got} == {n}
    signs = {}
    for i, deviation, row in zip(ids, deviations, whitened):
        for c in range(k):
            r = found[i][c + 1][0]
            assert r["deviation"] == deviation
            assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
            if abs(row[c]) > 1e-3:
                signs.setdefault(c, set()).add(np.sign(row[c]) == np.sign(r["whitened"]))
            assert abs(r["whitened"]) == pytest.approx(abs(row[c]), rel=1e-7, abs=1e-7)
    assert all(len(s) == 1 for s in signs.values())
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("d", [2, 3, 8, 64])
def test_against_another_decomposition(spark, d):
    vectors = random_vectors(d, 300, d)
    vectors += vectors[:40] + [vectors[0]] * 60
    df = spark.createDataFrame(rows_of(vectors), SCHEMA).repartition(7)
    check(W.whiten_embeddings(df).collect(), vectors, range(len(vectors)))


def test_given_table(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = df.collect()
    check(W.whiten_embeddings(df).collect(), [r["embedding"] for r in rows], [r["vec_id"] for r in rows])


def test_rows_that_leave(spark):
    vectors = random_vectors(1, 50, 3)
    bad = [None, [], [1.0, None, 2.0], [1.0, math.nan, 0.0], [math.inf, 0.0, 0.0], [1e30, 0.0, 0.0], [1.0, 2.0],
           [1.0, 2.0, 3.0, 4.0]]
    df = spark.createDataFrame(rows_of(bad + vectors, [*range(100, 108), *range(50)]), SCHEMA)
    check(W.whiten_embeddings(df).collect(), vectors, range(50))


def test_repeated_and_missing_ids(spark):
    vectors = random_vectors(2, 20, 4)
    got = W.whiten_embeddings(spark.createDataFrame(rows_of(vectors, [None] * 5 + [3] * 15), SCHEMA)).collect()
    assert len(got) == 80 and sum(r["vec_id"] is None for r in got) == 20
    assert sorted({r["deviation"] for r in got}) == sorted(set(brute(vectors)[1]))


def test_empty_and_single_and_flat(spark):
    assert W.whiten_embeddings(spark.createDataFrame([], SCHEMA)).count() == 0
    assert W.whiten_embeddings(spark.createDataFrame(rows_of([None, []]), SCHEMA)).count() == 0
    one = W.whiten_embeddings(spark.createDataFrame(rows_of([[1.0, 2.0]] * 3), SCHEMA)).collect()
    assert len(one) == 6 and {(r["n"], r["deviation"], r["whitened"], r["identity_error"]) for r in one} == {(1, 0, None, None)}
    line = W.whiten_embeddings(spark.createDataFrame(rows_of([[float(k), 0.0] for k in range(5)]), SCHEMA)).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line)
    assert {round(r["explained"], 9) for r in line} == {1.0, 0.0}


def test_numbers_beyond_64_bits(spark):
    vectors = [[2.0 ** 50, 1.0], [-(2.0 ** 52), 3.0], [0.0, 9.0]]
    got = W.whiten_embeddings(spark.createDataFrame(rows_of(vectors), SCHEMA)).collect()
    assert {r["deviation"] for r in got} == {None}
    assert len(got) == 6 and got[0]["identity_error"] < 1e-6


def residual(v):
    values, vectors = W.eigenpairs(v)
    size = max(np.abs(values).max(), np.finfo(float).tiny)
    assert (np.diff(values) <= 1e-14 * size).all()
    assert np.abs(vectors.T @ vectors - np.eye(len(v))).max() < 1e-13
    assert np.abs(v @ vectors - vectors * values).max() / size < 1e-13
    assert np.abs(values - np.linalg.eigvalsh(v)[::-1]).max() / size < 1e-12


def test_eigenpairs():
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    for d in (1, 2, 3, 17, 64):
        a = rng.normal(size=(d, d))
        residual(a @ a.T)
    spectra = [
        np.ones(40), np.repeat([1.0, 2.0], 20), np.repeat([1, 1 + 1e-9, 3, 0], 10), 10.0 ** -np.arange(40),
        np.r_[5, np.ones(39)], 1e30 * np.arange(40), 1e-30 * np.arange(40), np.r_[np.zeros(39), 1],
        np.r_[1 + 1e-15 * np.arange(40)], np.repeat([0, 1e-8, 1, 1e8], 10),
    ]
    for spectrum in spectra:
        v = q @ np.diag(spectrum) @ q.T
        residual((v + v.T) / 2)
    residual(np.zeros((5, 5)))
    residual(np.ones((30, 30)))
    residual(np.diag(np.arange(10.0)))


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(20, 20)))[0]
    values = np.r_[-np.logspace(-9, 3, 10), np.logspace(-7, 2, 10)]
    v = q @ np.diag(values) @ q.T
    assert np.abs(W.polar_factor((v + v.T) / 2) - q @ np.diag(np.sign(values)) @ q.T).max() < 1e-5
