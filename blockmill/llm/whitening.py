"""Embedding whitening by spectral divide and conquer.

Entries become whole numbers ``x = floor(256 * c)``. The *fit list* holds each distinct
vector once; its covariance V (divisor n, centred before multiplying) is added up by
Spark in numpy blocks. V has one row and column per dimension, so its decomposition is
driver work of fixed size:

* The polar factor of V minus a shift is +1 on the eigenvectors above the shift and -1
  below. It comes from the dynamically weighted Halley iteration (QDWH), whose steps
  are QR factorisations, then Cholesky ones, and which converges in six or so.
* Half of (factor + identity) is the spectral projector. Orthonormal bases of its range
  and of what is left split V into two smaller blocks, and each is split again, down to
  single components.

Components, means and eigenvalues then travel with the tasks that whiten all rows.

A row leaves if its vector is null or empty, holds a null or non-finite entry or one
whose ``x`` would not fit 62 bits, or is not as long as most vectors (the longer of equals).
Ids may be null or repeat; each row gives its own results. Components without variance
(below ``RANK_TOLERANCE`` of the largest eigenvalue) have null ``whitened``. A deviation
beyond 64 bits is null. Further columns are not read. An empty table, or one that no row
is left of, gives an empty table.

Skew: equal vectors meet in one shuffle that first drops copies in every task. Partial
sums are of d x d numbers; there are as many as gigabytes of vectors, and they are added
in two steps, row by row of the matrix. Nothing else leaves the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from blockmill.session import default_parallelism, stored

SCALE = 256
# Entries from here on would not fit the whole numbers.
LARGEST = float(1 << 54)
RANK_TOLERANCE = 1e-12
# Driver and tasks hold matrices of this many rows and columns at most.
MAX_DIMENSIONS = 4096
# Bytes of vectors behind one partial sum, and partial sums added in the first step.
TASK_BYTES = 1 << 30
SUMS_AT_ONCE = 64
_EPS = float(np.finfo(float).eps)


# ---- Spectral divide and conquer ----

def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix: its matrix sign."""
    n = len(a)
    size = math.sqrt(np.linalg.norm(a, 1) * np.linalg.norm(a, np.inf))
    if size == 0:
        return np.eye(n)
    x = a / size
    low = _smallest(x)
    for _ in range(60):
        low2 = low * low
        root = (4 * (1 - low2) / low2 ** 2) ** (1 / 3) if low < 1 else 0.0
        p = math.sqrt(1 + root) + 0.5 * math.sqrt(8 - 4 * root + 8 * (2 - low2) / (low2 * math.sqrt(1 + root)))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        before = x
        if r > 100:
            both = np.linalg.qr(np.vstack([math.sqrt(r) * x, np.eye(n)]))[0]
            x = q / r * x + (p - q / r) / math.sqrt(r) * both[:n] @ both[n:].T
        else:
            lower = np.linalg.cholesky(np.eye(n) + r * x.T @ x)
            x = q / r * x + (p - q / r) * np.linalg.solve(lower.T, np.linalg.solve(lower, x.T)).T
        x = (x + x.T) / 2
        low = min(1.0, low * (p + q * low2) / (1 + r * low2))
        if np.linalg.norm(x - before) <= _EPS ** (1 / 3) and 1 - low < 10 * _EPS:
            break
    return x


def _smallest(x: np.ndarray) -> float:
    """A lower bound of the smallest singular value; close to singular matrices get a tiny one."""
    try:
        inverse = np.linalg.norm(np.linalg.inv(x), 1)
    except np.linalg.LinAlgError:
        return _EPS
    if not math.isfinite(inverse):
        return _EPS
    return min(1.0, max(_EPS, 0.9 / (inverse * math.sqrt(len(x)))))


def _range_basis(projector: np.ndarray, rank: int) -> np.ndarray:
    """Orthonormal columns: first a basis of the projector's range, then one of the rest."""
    rest, chosen = projector.copy(), []
    for _ in range(rank):
        # The column with most left to say, as QR with column pivoting takes it.
        at = int(np.einsum("ij,ij->j", rest, rest).argmax())
        column = rest[:, at] / np.linalg.norm(rest[:, at])
        chosen.append(column)
        rest -= np.outer(column, column @ rest)
    start = projector @ np.array(chosen).T
    return np.linalg.qr(start, mode="complete")[0]


def _projector(a: np.ndarray, tiny: float) -> tuple[np.ndarray, int] | None:
    """A projector that splits the spectrum, or None if all eigenvalues are as good as equal."""
    diagonal = np.diag(a)
    reach = np.abs(a).sum(axis=1) - np.abs(diagonal)
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    shift = float(np.median(diagonal))
    n = len(a)
    while high - low > tiny:
        projector = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
        trace = float(np.trace(projector))
        rank = round(trace)
        if 0 < rank < n and abs(trace - rank) < 1e-6:
            return projector, rank
        if 0 < rank < n:
            # The shift lies on an eigenvalue; a little beside it does as well.
            moved = shift + 1e-3 * (high - low)
            shift = moved if moved < high else (low + shift) / 2
            high = low + 0.999 * (high - low)
            continue
        low, high = (low, shift) if rank == 0 else (shift, high)
        shift = (low + high) / 2
    return None


def eigenpairs(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and their unit eigenvectors as columns."""
    v = (v + v.T) / 2
    tiny = 4 * _EPS * max(float(np.linalg.norm(v)), np.finfo(float).tiny)
    values, vectors = [], []
    # Blocks still to be split, with the basis of their subspace.
    blocks = [(v, np.eye(len(v)))]
    while blocks:
        block, basis = blocks.pop()
        found = None
        if len(block) > 1 and np.linalg.norm(block - np.diag(np.diag(block))) > tiny:
            found = _projector(block, tiny)
        if found is None:
            values.append(np.diag(block))
            vectors.append(basis)
            continue
        projector, rank = found
        q = _range_basis(projector, rank)
        for part in (q[:, :rank], q[:, rank:]):
            inner = basis @ part
            # Taken from the whole matrix, so that errors do not add up over the splits.
            small = inner.T @ v @ inner
            blocks.append(((small + small.T) / 2, inner))
    values, vectors = np.concatenate(values), np.hstack(vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# ---- Sums over the fit list ----

def whole_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and whole-number vector ``x`` of all rows that are left, by their length too."""
    entry = F.col("v")
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(entry.isNotNull() & (F.size(entry) > 0) & good)
    return rows.select("id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("x"))


def common_length(vectors: DataFrame) -> int | None:
    counts = vectors.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    found = counts.orderBy(F.desc("n"), F.desc("d")).first()
    return found and found["d"]


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _add_up(rows: DataFrame) -> DataFrame:
    """Numbered arrays added position by position; ``part`` tells apart who made them."""

    def add(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, i, part = None, None, None
        for table in tables:
            i, part = table["i"][0].as_py(), table["part"][0].as_py()
            values = np.array(table["values"].to_pylist()).sum(axis=0)
            total = values if total is None else total + values
        yield pa.RecordBatch.from_arrays(
            [pa.array([i], pa.int32()), pa.array([part % SUMS_AT_ONCE], pa.int32()), pa.array([total])],
            names=["i", "part", "values"],
        )

    some = rows.groupBy("i", F.col("part") % SUMS_AT_ONCE).applyInArrow(add, rows.schema)
    return some.groupBy("i").applyInArrow(add, rows.schema)


_SUMS = "i int, part int, values array<{}>"


def _block_sums(vectors: DataFrame, d: int, kind: str, rows_of, n_rows: int, n_bytes: int) -> np.ndarray:
    """The sum over all vectors of a matrix that ``rows_of`` makes of a block of them."""
    spark = vectors.sparkSession
    schema = T.StructType.fromDDL(_SUMS.format(kind))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                made = rows_of(_matrix(batch.column(0), d))
                total = made if total is None else total + made
        if total is not None:
            part = TaskContext.get().partitionId()
            for i, values in enumerate(total):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([part], pa.int32()), pa.array([values], arrow.field(2).type)],
                    schema=arrow,
                )

    tasks = max(default_parallelism(spark), math.ceil(n_bytes / TASK_BYTES))
    found = _add_up(vectors.select("x").coalesce(tasks).mapInArrow(run, schema)).collect()
    out = np.zeros((n_rows, len(found[0]["values"])), found and np.array(found[0]["values"]).dtype)
    for row in found:
        out[row["i"]] = row["values"]
    return out


# ---- Fitting and whitening ----

@dataclass(frozen=True, eq=False)
class Whitening:
    """What a fit has found; components are the rows of ``axes``."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def means(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def usable(self) -> np.ndarray:
        """Components that have a variance to divide by."""
        return self.values > RANK_TOLERANCE * max(float(self.values[0]), np.finfo(float).tiny)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """One row of whitened values per vector; NaN where a component has no variance."""
        out = np.full((len(x), len(self.axes)), np.nan)
        use = self.usable
        out[:, use] = ((x - self.means) @ self.axes[use].T) / np.sqrt(self.values[use])
        return out

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - S)^2; None where 64 bits do not hold them."""
        largest = max(int(np.abs(x).max(initial=0)) * self.n, 0) + max(map(abs, self.sums))
        if largest ** 2 * len(self.sums) < 1 << 63:
            gaps = self.n * x - np.array(self.sums, np.int64)
            return (gaps * gaps).sum(axis=1).tolist()
        exact = [sum((self.n * c - s) ** 2 for c, s in zip(row, self.sums)) for row in x.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def fit_whitening(fit_list: DataFrame, d: int, n_components: int) -> Whitening | None:
    """Means and leading components of a table of distinct vectors ``x``; None if it is empty."""
    if d > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {d} entries; at most {MAX_DIMENSIONS} can be decomposed")
    n = fit_list.count()
    if n == 0:
        return None
    size = 8 * n * d

    def halves(x: np.ndarray) -> np.ndarray:
        # Upper and lower 32 bits apart, so that no sum of a task runs over.
        return np.stack([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])

    upper, lower = _block_sums(fit_list, d, "bigint", halves, 2, size).tolist()
    sums = tuple((a << 32) + b for a, b in zip(upper, lower))
    means = np.array([s / n for s in sums])

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - means
        return centred.T @ centred

    covariance = _block_sums(fit_list, d, "double", products, d, size) / n
    values, vectors = eigenpairs(covariance)
    k = min(n_components, d)
    return Whitening(n, sums, vectors[:, :k].T.copy(), values[:k].copy(), float(np.trace(covariance)))


def identity_error(fit_list: DataFrame, d: int, model: Whitening) -> float | None:
    """Largest entry, in size, of the whitened fit list's covariance minus the identity."""
    k = int(model.usable.sum())
    if k == 0:
        return None

    def moments(x: np.ndarray) -> np.ndarray:
        w = model.whiten(x)[:, model.usable]
        return np.vstack([w.T @ w, w.sum(axis=0)])

    found = _block_sums(fit_list, d, "double", moments, k + 1, 8 * model.n * d) / model.n
    covariance = found[:k] - np.outer(found[k], found[k])
    return float(np.abs(covariance - np.eye(k)).max())


SCHEMA = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten_embeddings(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", n_components: int = 4
) -> DataFrame:
    """One row for each remaining row and component: whitened value, share of variance and checks.

    The fit list is written to the shared folder; sums, components and checks are made
    when this is called, the rows when the result is read.
    """
    spark = df.sparkSession
    schema = T.StructType.fromDDL(SCHEMA)
    schema.fields[0] = T.StructField(key, dict((f.name, f.dataType) for f in df.schema)[key])
    vectors = whole_vectors(df, key, vector)
    d = common_length(vectors)
    if d is None:
        return spark.createDataFrame([], schema)
    vectors = vectors.filter(F.size("x") == d)
    fit_list = stored(vectors.select("x").distinct(), "whitening")
    model = fit_whitening(fit_list, d, n_components)
    error = identity_error(fit_list, d, model)
    explained = [float(e / model.trace) if model.trace > 0 else None for e in model.values]
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.axes)
        for batch in batches:
            x = _matrix(batch.column(1), d)
            rows = np.repeat(np.arange(len(x)), k)
            whitened = model.whiten(x).ravel()
            columns = [
                batch.column(0).take(pa.array(rows)),
                np.tile(np.arange(1, k + 1), len(x)),
                np.full(len(rows), model.n),
                pa.array(model.deviations(x), pa.int64()).take(pa.array(rows)),
                pa.array(whitened, mask=np.isnan(whitened)),
                explained * len(x),
                [error] * len(rows),
            ]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

    return vectors.select("id", "x").mapInArrow(run, schema)
