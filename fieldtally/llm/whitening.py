"""Whitening of vectors by their principal directions, without their covariance matrix.

A block of directions Q is turned towards the principal ones: each pass over the
vectors gives VQ = X'(XQ)/n on centred rows, summed within every task; on the
driver, whose matrices have as many rows as a vector has entries and no more,
Rayleigh-Ritz finds the best directions within the block and QR makes the next
block.  Passes go on until the residuals of all wanted directions certify them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table


@dataclass(frozen=True)
class Settings:
    """At most ``components`` directions, sought with ``extra`` more columns than
    that.  A direction is certified when its residual |Vu - eu| is at most
    ``tolerance`` times the largest eigenvalue, and has a variance when its
    eigenvalue is above ``least`` times that.  A pass after which the largest
    residual is more than ``slow`` times the one before doubles the block, up to
    ``widest`` columns; with as many columns as entries, one pass is exact.
    Entries are whole numbers: the floor of ``scale`` times what is given."""

    components: int = 32
    extra: int = 8
    tolerance: float = 1e-13
    least: float = 1e-11
    slow: float = 0.1
    widest: int = 1024
    most_passes: int = 500
    scale: float = 64.0
    seed: int = 0


@dataclass(frozen=True)
class Fit:
    """``n`` vectors with the exact ``sums`` of their entries, the eigenvalues
    ``variances`` of ``directions`` (columns), their shares ``explained`` of the
    whole variance, and how many passes over the vectors found them."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    passes: int

    def centred(self, y: np.ndarray) -> np.ndarray:
        """Rows less their mean; its whole part is taken off first, without rounding."""
        whole = [s // self.n for s in self.sums]
        rest = [(s - w * self.n) / self.n for s, w in zip(self.sums, whole)]
        return (y - np.array(whole, float)) - np.array(rest)

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return self.centred(y) @ (self.directions / np.sqrt(self.variances))

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """The exact sum of (n * y - sums)**2 of each row; None beyond a long."""
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.sums), default=0)
        rough = ((self.n * y - np.array(self.sums, float)) ** 2).sum(1)
        exact: list[int | None] = [None] * len(y)
        if most < 1 << 62:
            v = self.n * y.astype(np.int64) - np.array(self.sums, np.int64)
            exact = (v * v).sum(1).tolist()  # modulo 2**64, which is exact for what fits
        for i in np.flatnonzero(rough > 0.99 * 2.0**63 if most < 1 << 62 else np.full(len(y), True)).tolist():
            exact[i] = None
            if rough[i] < 1.01 * 2.0**63:
                whole = sum((self.n * int(a) - s) ** 2 for a, s in zip(y[i], self.sums))
                exact[i] = whole if whole < 1 << 63 else None
        return exact


#: Sums of tasks are added up again in this many tasks, so the driver gets no more.
_ADDERS = 32


def _matrices(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _row(values: list, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values], pa.list_(kind))], ["y"])


def _summed(rows: DataFrame, width: int, each: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``each`` (``width`` numbers) over the matrices of all rows."""

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for _, y in _matrices(batches):
            total += each(y).ravel()
        yield _row(total.tolist(), pa.float64())

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for _, sums in _matrices(batches):
            total += sums.sum(0)
        yield _row(total.tolist(), pa.float64())

    parts = rows.select("y").mapInArrow(within, "y array<double>").repartition(_ADDERS)
    return np.sum([r.y for r in parts.mapInArrow(across, "y array<double>").collect()], axis=0)


def _exact_sums(rows: DataFrame, d: int) -> tuple[int, ...]:
    """Whole numbers are summed as such, however large."""

    def add(total: list[int], sums: list[int]) -> list[int]:
        return [a + int(b) for a, b in zip(total, sums)]

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for _, y in _matrices(batches):
            small = np.abs(y).max(initial=0) < 1 << 40 and len(y) < 1 << 20
            total = add(total, y.astype(np.int64).sum(0).tolist() if small else [sum(map(int, c)) for c in y.T])
        yield _row([str(t) for t in total], pa.string())

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for batch in batches:
            for sums in batch.column(0).to_pylist():
                total = add(total, sums)
        yield _row([str(t) for t in total], pa.string())

    parts = rows.select("y").mapInArrow(within, "y array<string>").repartition(_ADDERS)
    total = [0] * d
    for r in parts.mapInArrow(across, "y array<string>").collect():
        total = add(total, r.y)
    return tuple(total)


def _entries(vectors: DataFrame, id_col: str, vector_col: str, s: Settings) -> DataFrame:
    """``id`` and whole ``y`` of the vectors without null and non-finite entries."""
    v = F.col(vector_col).cast("array<double>")
    good = F.col(vector_col).isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.where(good).select(F.col(id_col).alias("id"), v.alias("y"))

    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            edges = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32)
            whole = np.floor(s.scale * lists.flatten().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(edges), pa.array(whole))], ["id", "y"])

    return rows.mapInArrow(floor, f"id {rows.schema['id'].dataType.simpleString()}, y array<double>")


def _principal(rows: DataFrame, n: int, d: int, s: Settings) -> Fit:
    """Block subspace iteration over the written rows ``y``, each of ``d`` entries."""
    centre = Fit(n, _exact_sums(rows, d), np.zeros((d, 0)), np.zeros(0), np.zeros(0), 0)
    rng, k = np.random.default_rng(s.seed), min(s.components, d)
    q = np.linalg.qr(rng.normal(size=(d, min(d, k + s.extra))))[0]
    before = np.inf
    for passes in range(1, s.most_passes + 1):
        m = q.shape[1]

        def product(y: np.ndarray, q: np.ndarray = q) -> np.ndarray:
            c = centre.centred(y)
            return np.concatenate([(c.T @ (c @ q)).ravel(), [(c * c).sum()]])

        out = _summed(rows, d * m + 1, product) / n
        z, trace = out[:-1].reshape(d, m), out[-1]
        t = q.T @ z
        e, w = np.linalg.eigh((t + t.T) / 2)
        e, w = e[::-1], w[:, ::-1]
        u, vu = q @ w, z @ w
        residual = np.linalg.norm(vu[:, :k] - u[:, :k] * e[:k], axis=0).max(initial=0)
        if m == d or residual <= s.tolerance * max(e[0], 0):
            break
        block = vu
        if residual > s.slow * before and m < min(d, s.widest):
            block = np.concatenate([vu, rng.normal(size=(d, min(2 * m, d, s.widest) - m)) * max(e[-1], 0)], axis=1)
        before = residual
        q = np.linalg.qr(block)[0]
    else:
        raise RuntimeError(f"residual {residual / e[0]:.3g} of the largest eigenvalue after {passes} passes; raise Settings.widest or tolerance")
    k = int((e[:k] > s.least * max(e[0], 0)).sum())
    u = u[:, :k] / np.linalg.norm(u[:, :k], axis=0)
    u *= np.where(u[np.abs(u).argmax(0), np.arange(k)] < 0, -1, 1)
    return Fit(n, centre.sums, u, e[:k].copy(), e[:k] / trace if k else np.zeros(0), passes)


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings = Settings()) -> tuple[Fit | None, DataFrame]:
    """The principal directions of all vectors, and the rows (``id``, ``y``) that
    were fitted; no directions without rows.

    Vectors that are null or empty, or that hold null or non-finite entries, are
    left out, and so are vectors of another length than the usual one (of
    lengths that are equally usual, the greater), which can't be compared.
    """
    rows = Table(_entries(vectors, id_col, vector_col, settings), "vectors").read()
    usual = rows.groupBy(F.size("y").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if usual is None:
        return None, rows
    rows = rows.where(F.size("y") == usual.d)
    return _principal(rows, usual.n, usual.d, settings), rows


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """For each fitted vector and component: ``id_col``, ``component`` (from 1 by
    falling eigenvalue), ``n``, ``deviation`` (exact sum of (n * x - S)**2; null
    beyond a long), ``whitened`` (the centred vector along the component, in units
    of its deviation), ``explained`` (share of the variance) and
    ``identity_error``: how far the covariance of ``whitened``, found by a pass of
    its own, is from the identity.

    A direction of hardly any variance (``Settings.least``) is no component: where
    all vectors are equal there is none.  Directions of equal variance may be any
    that span them.  Null ids are kept; repeated rows count as often as they
    stand; other columns are ignored; an empty table, or one without usable
    vectors, gives an empty result.  See ``fit`` for what is left out.
    """
    found, rows = fit(vectors, id_col, vector_col, settings)
    k = 0 if found is None else len(found.variances)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not k:
        return rows.limit(0).selectExpr("id", "cast(0 as int) as component", "0L as n", "0L as deviation", "0d as whitened", "0d as explained", "0d as identity_error").withColumnRenamed("id", id_col)

    def moments(y: np.ndarray) -> np.ndarray:
        w = found.whitened(y)
        return np.concatenate([(w.T @ w).ravel(), w.sum(0)])

    sums = _summed(rows, k * k + k, moments) / found.n
    covariance = sums[: k * k].reshape(k, k) - np.outer(sums[k * k :], sums[k * k :])
    error = float(np.abs(covariance - np.eye(k)).max())

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, y in _matrices(batches, 1):
            for i in range(0, len(y), 1024):
                part, ids = y[i : i + 1024], batch.column(0).slice(i, 1024)
                m = len(part)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, found.n, np.int64)),
                    pa.array(found.deviations(part), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(found.whitened(part).ravel()),
                    pa.array(np.tile(found.explained, m)),
                    pa.array(np.full(m * k, error)),
                ], ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("id", "y").mapInArrow(spread, schema).withColumnRenamed("id", id_col)
