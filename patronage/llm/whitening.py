"""Whitening of embeddings by spectral divide and conquer.

Entries become whole numbers of 256ths.  The covariance of the distinct vectors is summed in
the tasks, centred first, and merged row by row.  Its leading eigenvectors come from polar
decompositions: the polar factor U of the covariance less a shift, computed by the QR-based
dynamically weighted Halley iteration, is the matrix sign function, (U + I) / 2 projects on
the eigenvectors above the shift, and the covariance restricted to that subspace and to its
complement is split again, until the parts are single components or multiples of the
identity.  Parts below the wanted components are never split.  The broadcast result, a few
vectors, whitens every row.

Only figures of size d x d reach the driver (d entries of a vector), which the iteration
needs; rows and distinct vectors stay in the tasks.

Defined cases: rows whose vector is null or holds null or non-finite entries are dropped;
a shorter vector has zeros at its end; entries beyond the range of bigint are its ends; a
deviation that bigint can't hold is null; components whose variance is zero to double
precision are not returned, so equal vectors, one vector or an empty table give no rows;
repeated rows and null ids get their own rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from patronage.functions.stages import cut

SCALE = 256  # a unit of a vector's entry
_EPS = np.finfo(np.float64).eps
_HALLEY_STEPS = 60
_ROWS = 4096  # vectors multiplied at once


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by dynamically weighted Halley steps."""
    m = len(a)
    scale = np.sqrt(np.linalg.norm(a, 1) * np.linalg.norm(a, np.inf))
    x, low, one = a / scale, _EPS, np.eye(m)  # low: a bound of the least singular value, driven to 1
    for _ in range(_HALLEY_STEPS):
        square = low * low
        gap = np.cbrt(4 * (1 - square) / square**2)
        weight = np.sqrt(1 + gap) + np.sqrt(8 - 4 * gap + 8 * (2 - square) / (square * np.sqrt(1 + gap))) / 2
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        if c > 100:  # far from orthogonal: by QR, which is stable at any condition
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, one]))
            new = b / c * x + (weight - b / c) / np.sqrt(c) * (q[:m] @ q[m:].T)
        else:
            new = b / c * x + (weight - b / c) * np.linalg.solve(one + c * (x.T @ x), x.T).T
        low = min(1.0, low * (weight + b * square) / (1 + c * square))
        step = np.linalg.norm(new - x)
        x = (new + new.T) / 2
        if low > 1 - 10 * _EPS and step < np.cbrt(_EPS):
            break
    return x


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Where to split a spectrum: near its middle first; the mean always has eigenvalues on both sides."""
    diagonal, m = np.diag(a), len(a)
    mean = diagonal.mean()
    spread = np.linalg.norm(a - mean * np.eye(m)) / np.sqrt(m)
    yield (np.sort(diagonal)[(m - 1) // 2] + np.sort(diagonal)[m // 2]) / 2
    for t in (0.0, 0.31, -0.31, 0.17, -0.17, 0.53, -0.53, 0.07, -0.07, 0.71, -0.71, 0.013, -0.013, 0.0017, -0.0017):
        yield mean + t * spread


def _split(a: np.ndarray, negligible: float) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first columns span the eigenvectors above some shift, and their number."""
    m = len(a)
    rng = np.random.default_rng(m)
    best = None
    for shift in _shifts(a):
        moved = a - shift * np.eye(m)
        if not moved.any():
            continue
        projector = (polar_factor(moved) + np.eye(m)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < m:
            continue
        basis = rng.standard_normal((m, m))
        for _ in range(2):
            upper = projector @ basis[:, :rank]
            basis, _ = np.linalg.qr(np.hstack([upper, basis[:, rank:] - projector @ basis[:, rank:]]))
        left = np.linalg.norm(basis[:, rank:].T @ a @ basis[:, :rank])
        if best is None or left < best[0]:
            best = left, basis, rank
        if left <= negligible:
            break
    return None if best is None else best[1:]


def leading_components(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to k leading eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    a = (a + a.T) / 2
    negligible = 4 * len(a) * _EPS * max(np.linalg.norm(a), np.finfo(np.float64).tiny)
    found: list[np.ndarray] = []

    def descend(part: np.ndarray, basis: np.ndarray, wanted: int) -> None:
        if wanted <= 0:
            return
        alone = len(part) == 1 or np.linalg.norm(part - np.diag(np.diag(part))) <= negligible
        divided = None if alone else _split(part, negligible)
        if divided is None:
            found.extend(basis[:, np.argsort(-np.diag(part), kind="stable")[:wanted]].T)
            return
        turn, rank = divided
        for side, need in ((turn[:, :rank], wanted), (turn[:, rank:], wanted - rank)):
            inner = side.T @ part @ side
            descend((inner + inner.T) / 2, basis @ side, need)

    descend(a, np.eye(len(a)), k)
    vectors = np.array(found).T.reshape(len(a), -1)
    vectors /= np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Whitening:
    """What whitening needs: a few vectors of the length of the data's."""

    n: int  # distinct vectors
    sums: list[int]  # of them by entry, exact
    values: np.ndarray  # variances of the components, falling
    vectors: np.ndarray  # components as columns
    variance: float  # of all entries together
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def whole(embedding: Column) -> Column:
    """The vector in whole 256ths, rounded down."""
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint"))


def usable(vectors: DataFrame) -> DataFrame:
    """The rows whose vector is not null and has finite entries only."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != F.lit(float("inf"))))
    return vectors.where(F.col("embedding").isNotNull() & finite)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Lists of whole numbers as rows of d entries; shorter lists end in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), d), np.int64)
    out[np.arange(d) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for lo in range(0, batch.num_rows, _ROWS):
            yield _matrix(batch["x"].slice(lo, _ROWS), d)


def _entry_sums(fit: DataFrame, d: int) -> list[int]:
    """Exact sums by entry; high and low halves are summed apart, so none overflows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(d, np.int64), np.zeros(d, np.int64)
        for x in _matrices(batches, d):
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(high), pa.array(low)], ["i", "high", "low"])

    halves = fit.mapInArrow(add, "i int, high bigint, low bigint").groupBy("i").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return [(r["high"] << 32) + r["low"] for r in sorted(halves.collect())]  # d rows


def _covariance(fit: DataFrame, n: int, mean: np.ndarray) -> np.ndarray:
    """Centred products summed in the tasks, rows of the matrix merged apart; d rows reach the driver."""
    d = len(mean)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for x in _matrices(batches, d):
            centred = x - mean
            total += centred.T @ centred
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([row.tobytes() for row in total], pa.binary())], ["i", "row"])

    def merge(rows: pa.Table) -> pa.Table:
        total = np.frombuffer(b"".join(rows["row"].to_pylist())).reshape(-1, d).sum(axis=0)
        return pa.table({"i": rows["i"][:1], "row": pa.array([total.tobytes()], pa.binary())})

    # One row per task and entry; a group holds as many rows as there are tasks.
    merged = fit.mapInArrow(multiply, "i int, row binary").groupBy("i").applyInArrow(merge, "i int, row binary")
    return np.stack([np.frombuffer(r["row"]) for r in sorted(merged.collect())]) / n


def fit_whitening(vectors: DataFrame, k: int = 4) -> Whitening | None:
    """The k leading components of the distinct vectors; None where there are none."""
    fit = cut(usable(vectors).select(whole(F.col("embedding")).alias("x")).distinct(), "distinct-vectors")
    n, d = fit.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n or not d:
        return None
    sums = _entry_sums(fit, d)
    model = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0)
    covariance = _covariance(fit, n, model.mean)
    values, components = leading_components(covariance, k)
    some = values > 4 * d * _EPS * np.trace(covariance)
    if not some.any():
        return None
    model.values, model.vectors, model.variance = values[some], components[:, some], float(np.trace(covariance))
    model.identity_error = _identity_error(fit, model)
    return model


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened distinct vectors' covariance less the identity; Spark's aggregate is centred."""
    white = _whitened(fit, model)
    pairs = [(i, j) for i in range(len(model.values)) for j in range(i + 1)]
    found = white.agg(*(F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) for i, j in pairs)).first()
    return max(abs(c - (i == j)) for (i, j), c in zip(pairs, found, strict=True))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum of (n * x - S)**2 by row, exact."""
    most = n * max(int(x.max()), -int(x.min())) + max(map(abs, sums)) if x.size else 0
    if most * most * x.shape[1] < 1 << 62:
        y = n * x - np.array(sums, np.int64)
        return pa.array((y * y).sum(axis=1))
    exact = (sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist())
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def _whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """Rows of x with deviation and whitened."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # as many numbers as the components have
    others = [c for c in rows.columns if c != "x"]
    schema = rows.select(*others, F.lit(0).cast("bigint").alias("deviation"), F.array(F.lit(0.0)).alias("whitened")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        mean, scaled, width = m.mean, m.vectors / np.sqrt(m.values), len(m.values)
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                part = batch.slice(lo, _ROWS)
                x = _matrix(part["x"], len(m.sums))
                white = pa.array(((x - mean) @ scaled).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * width, pa.int32()), white)
                yield pa.RecordBatch.from_arrays([*(part[c] for c in others), _deviations(x, m.n, m.sums), lists], names=schema.names)

    return rows.mapInArrow(run, _nullable(schema))


def _nullable(schema):
    """The schema with every column allowed to be null."""
    for field in schema.fields:
        field.nullable = True
    return schema


def whiten(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """vec_id, deviation and whitened (one entry per component) of every usable row."""
    if model is None:
        return vectors.limit(0).selectExpr("vec_id", "CAST(NULL AS bigint) AS deviation", "CAST(NULL AS array<double>) AS whitened")
    return _whitened(usable(vectors).select("vec_id", whole(F.col("embedding")).alias("x")), model)


def whitened_components(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row per usable row and component."""
    known = model or Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 1.0)
    explained = F.array(*(F.lit(float(v / known.variance)) for v in known.values)) if len(known.values) else F.lit(None).cast("array<double>")
    return (
        whiten(vectors, model)
        .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            "vec_id",
            (F.col("at") + 1).alias("component"),
            F.lit(known.n).cast("bigint").alias("n"),
            "deviation",
            "whitened",
            F.get(explained, F.col("at")).alias("explained"),
            F.lit(known.identity_error).alias("identity_error"),
        )
    )
