"""Whitened embeddings against a dense eigendecomposition."""

import math

import numpy as np
import pytest

from tabletide.llm import whitening
from tabletide.llm.queries import op12_embedding_whitening, read


def brute(rows, k):
    """Rows of (id, vector) by numpy's dense eigenvectors: n, eigenvalues, explained shares, deviations, and whitened values by id up to sign."""
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in good], object)
    n, sums = len(x), x.sum(0)
    deviation = [int(((n * r - sums) ** 2).sum()) for r in x]
    c = x.astype(float) - sums.astype(float) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return n, values, values / (c**2).sum() * n, deviation, (c @ vectors) / np.sqrt(values)


def check(df, rows, k):
    n, values, share, deviation, white = brute(rows, k)
    ids = [i for i, v in rows if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)]
    found = df.orderBy("vec_id", "component").collect()
    assert len(found) == len(ids) * k
    assert {(r.vec_id, r.n, r.deviation) for r in found} == set(zip(ids, [n] * n, deviation))
    got = np.array([r.whitened for r in found]).reshape(n, k)
    want = white[np.argsort(ids)]
    assert np.allclose(np.abs((got * want).mean(0)), 1, atol=1e-9)
    assert np.allclose(got * np.sign((got * want).mean(0)), want, atol=1e-7)
    assert np.allclose([r.explained for r in found[:k]], share, rtol=1e-9)
    assert np.abs(np.cov(got.T, bias=True) - np.eye(k)).max() < 1e-9
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


def test_query(spark, small):
    rows = [(r.vec_id, r.embedding) for r in read(spark, small, "embeddings").collect()]
    check(op12_embedding_whitening(spark, small), rows, 8)


DDL = "vec_id long, embedding array<float>, component string, n string"


def test_odd_rows(spark):
    r = np.random.default_rng(5)
    good = [(i, (r.standard_normal(12) * np.arange(1, 13)).astype(np.float32).tolist()) for i in range(300)]
    odd = [(900, None), (901, []), (902, [1.0] * 11 + [None]), (903, [float("nan")] + [0.0] * 11), (904, [float("-inf")] + [0.0] * 11)]
    short = [(905, [1.0, 2.0])]
    docs = spark.createDataFrame([(i, v, "x", None) for i, v in good + odd + short], DDL).repartition(5)
    check(whitening.whiten(docs, 5), good + odd, 5)
    ids = whitening.whiten(spark.createDataFrame([(None if i < 2 else 7, v, "x", None) for i, v in good], DDL), 1).select("vec_id").collect()
    assert sorted(ids, key=str) == sorted([(None,)] * 2 + [(7,)] * 298, key=str)


def test_few_rows_and_dimensions(spark):
    def run(vectors, k=8):
        return whitening.whiten(spark.createDataFrame([(i, v, None, None) for i, v in enumerate(vectors)], DDL), k).collect()

    assert run([]) == [] and run([None]) == []
    assert run([[1.0, 2.0]]) == [] and run([[1.0, 2.0]] * 5) == []
    assert {r.component for r in run([[1.0, 0.0], [0.0, 1.0], [1.0, 1.0]])} == {1, 2}
    line = run([[float(i), 2.0 * i, 0.0] for i in range(10)])  # one direction has variance
    assert {r.component for r in line} == {1} and line[0].explained == pytest.approx(1)


def test_equal_eigenvalues(spark):
    """Any orthonormal vectors of the space do, but they are the same for all rows."""
    rows = [[s * float(k == i) for i in range(4)] for k in range(4) for s in (1, -1)] * 3
    found = whitening.whiten(spark.createDataFrame([(i, v, None, None) for i, v in enumerate(rows)], DDL), 4).orderBy("vec_id", "component").collect()
    got = np.array([r.whitened for r in found]).reshape(len(rows), 4)
    assert np.abs(np.cov(got.T, bias=True) - np.eye(4)).max() < 1e-9 and (got[:8] == got[8:16]).all()


@pytest.mark.parametrize("flat", [False, True])
def test_passes(spark, flat):
    """Few passes also where eigenvalues are close, and results that don't depend on partitions; residuals certify the vectors."""
    r = np.random.default_rng(1)
    x = r.standard_normal((2000, 40)) * (1 if flat else 0.8 ** np.arange(40))
    docs = spark.createDataFrame([(i, v.astype(np.float32).tolist(), None, None) for i, v in enumerate(x)], DDL)
    one = whitening.components(whitening.usable(docs.coalesce(1)), 3)
    many = whitening.components(whitening.usable(docs.repartition(whitening.PARTS + 9)), 3)
    assert one.passes <= 40 and np.allclose(one.values, many.values, rtol=1e-12)
    assert np.allclose(np.abs((one.vectors * many.vectors).sum(0)), 1, atol=1e-12)
    assert (one.residuals <= 1e-9 * one.values[0]).all()


def test_large_numbers(spark):
    """Deviations are exact where products of 64 bits would overflow, and an error where the result itself would."""
    x = np.array([[100_000 + 2_000_000 * i] for i in range(50)], np.int64)
    n, sums = len(x), x.sum(0)
    assert list(whitening._deviation(x, n, sums)) == [int((n * int(v) - int(sums[0])) ** 2) for v in x[:, 0]]
    with pytest.raises(OverflowError):
        whitening._deviation(x * 1000, n, sums * 1000)
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e30], None, None)], DDL)).collect()
