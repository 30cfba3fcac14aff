"""Whitening against whole numbers in plain Python and numpy's own eigenvectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldtally.llm import whitening
from tests.conftest import DATA


def brute(rows, scale=64, k=32):
    xs = [[int(np.floor(scale * float(c))) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(xs), [sum(c) for c in zip(*xs)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(x, sums)) for x in xs]
    c = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in xs])
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, deviation, e, u, c @ u / np.sqrt(e), e / ((c * c).sum() / n)


def good(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v)


def compare(got, rows, k=32):
    """``rows`` have different ids."""
    n, deviation, _, _, whitened, explained = brute(rows, k=k)
    k = whitened.shape[1]
    at = {i: j for j, (i, _) in enumerate(rows)}
    own = np.full((n, k), np.nan)
    assert len(got) == n * k
    for r in got:
        assert (r.n, r.deviation) == (n, deviation[at[r.vec_id]])
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9) and r.identity_error < 1e-9
        own[at[r.vec_id], r.component - 1] = r.whitened
    sign = np.sign((own * whitened).sum(0))
    np.testing.assert_allclose(own * sign, whitened, atol=1e-8)


def test_against_numpy(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect() if good(r.embedding)]
    compare(whitening.whitened(df.repartition(7)).collect(), rows)


def vectors(spark, rows, kind="long"):
    return spark.createDataFrame(rows, f"vec_id {kind}, embedding array<float>")


def test_few_columns_find_what_stands_out(spark):
    rng = np.random.default_rng(3)
    basis = np.linalg.qr(rng.normal(size=(60, 60)))[0]
    values = (rng.normal(size=(400, 60)) * (20 * 0.5 ** np.arange(60))) @ basis.T
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(values)]
    s = whitening.Settings(components=3, extra=5, widest=8)
    found, _ = whitening.fit(vectors(spark, rows), settings=s)
    _, _, e, u, _, _ = brute(rows, k=3)
    assert 3 < found.passes < 60
    np.testing.assert_allclose(found.variances, e, rtol=1e-10)
    np.testing.assert_allclose(np.abs((found.directions * u).sum(0)), 1, atol=1e-12)


def test_a_slow_block_grows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(300, 48)).tolist())]
    found, _ = whitening.fit(vectors(spark, rows), settings=whitening.Settings(components=4, extra=2))
    assert found.passes <= 6
    np.testing.assert_allclose(found.variances, brute([(i, np.float32(v)) for i, v in rows], k=4)[2], rtol=1e-10)
    with pytest.raises(RuntimeError, match="passes"):
        whitening.fit(vectors(spark, rows), settings=whitening.Settings(components=4, extra=2, widest=6, most_passes=3))


@pytest.mark.parametrize("kind,make", [("int", int), ("long", int), ("string", str)])
def test_odd_rows_and_kinds_of_ids(spark, kind, make):
    rng = np.random.default_rng(5)
    usable = [(make(i), v) for i, v in enumerate(rng.normal(size=(40, 6)).astype(np.float32).tolist())]
    odd = [(make(90), None), (make(91), []), (make(92), [1.0, None, 1.0, 1.0, 1.0, 1.0]), (make(93), [float("nan")] * 6), (make(94), [float("inf")] * 6), (make(95), [1.0, 2.0])]
    df = vectors(spark, usable + odd, kind).selectExpr("*", "'x' as component", "0 as n", "'y' as id", "1 as y")
    compare(whitening.whitened(df).collect(), usable)
    assert whitening.whitened(df).schema["vec_id"].dataType.simpleString() == df.schema["vec_id"].dataType.simpleString()


def test_nothing_to_whiten(spark):
    empty = vectors(spark, [(1, None)])
    assert whitening.whitened(empty).count() == 0 and whitening.whitened(empty.limit(0)).count() == 0
    assert whitening.whitened(vectors(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    assert whitening.whitened(empty).columns == whitening.whitened(vectors(spark, [(1, [1.0]), (2, [2.0])])).columns


def test_repeated_rows_null_ids_and_few_directions(spark):
    line = vectors(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 4.0]), (2, [5.0, 6.0])])
    got = whitening.whitened(line).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (1, 1), (1, 1), (2, 1)]
    assert np.mean([r.whitened for r in got]) == pytest.approx(0) and np.mean([r.whitened**2 for r in got]) == pytest.approx(1)


def test_large_entries(spark):
    huge = [(i, [float(np.float32(x)) for x in (3e38 * (-1) ** i, 1e9 * i, i)]) for i in range(8)]
    got = whitening.whitened(vectors(spark, huge)).collect()
    assert got and all(r.deviation is None for r in got)
    large = [(i, [float(np.float32(c)) for c in (3e5 * i, -2e5 * i * i, 7.0 * (i % 3))]) for i in range(8)]
    own = {r.vec_id: r.deviation for r in whitening.whitened(vectors(spark, large)).collect()}
    assert own == {i: v if v < 2**63 else None for i, v in enumerate(brute(large)[1])} and None in own.values()


def test_sums_are_exact(spark):
    rows = spark.createDataFrame([(i, [float(2**52 + i), -1.0]) for i in range(2000)], "id long, y array<double>").repartition(5)
    assert whitening._exact_sums(rows, 2) == (sum(2**52 + i for i in range(2000)), -2000)
    assert rows.select(F.size("y")).distinct().count() == 1
