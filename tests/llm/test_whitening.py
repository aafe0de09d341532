"""op12 against plain numpy and exact integers."""

import math
import random

import numpy as np
import pytest

from tripmart.llm import queries
from tripmart.llm import whitening as W

SCHEMA = "vec_id bigint, embedding array<double>, n string"


def brute(rows, count=32):
    """Rows (id, component, n, deviation, |whitened|, explained) by numpy's eigenvalues."""
    sound = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
             if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in sound], object)
    n, s = len(x), x.sum(axis=0)
    dev = n * x - s
    y = (dev / n).astype(float)
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(count, int((e > e[0] * 1e-12).sum()))
    z = y @ (q[:, :k] / np.sqrt(e[:k]))
    out = []
    for (i, _), d, w in zip(sound, dev, z):
        out += [(i, c + 1, n, int((d * d).sum()), abs(w[c]), e[c] / e.sum()) for c in range(k)]
    return out


def compare(got, want):
    got = sorted((r.vec_id is not None, r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got)
    want = sorted((r[0] is not None, *r) for r in want)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-6, atol=1e-8)
    np.testing.assert_allclose([r[6] for r in got], [r[6] for r in want], rtol=1e-9)


def test_given_embeddings(spark, sf_small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    got = queries.op12_whitening(spark, sf_small)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.collect()
    compare(got, brute(rows))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_bad_rows_ties_and_clashing_columns(spark):
    rng = np.random.RandomState(3)
    base = rng.normal(size=(200, 6)) * [9, 5, 3, 2, 1, 0.5]
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(7, base[7].tolist()), (None, base[8].tolist())] * 2                  # repeated rows, null ids
    bad = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (903, [float("nan")] * 6), (904, [float("inf")] * 6),
           (905, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + bad], SCHEMA).repartition(5)
    out = W.whiten(df)
    assert out.columns[:3] == ["vec_id", "component", "n"]
    compare(out.collect(), [r for r in brute(rows)])


def test_exact_whatever_the_partitioning_and_the_size(spark):
    rng = random.Random(1)
    for scale in (1.0, 1e5, 1e9):
        rows = [(i, [rng.gauss(0, 1) * scale for _ in range(4)]) for i in range(300)]
        x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
        n = len(x)
        s = [sum(c) for c in zip(*x)]
        want = [[sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x) // n for j in range(4)] for i in range(4)]
        for parts in (1, 7):
            found = W.fit(W.grid(spark.createDataFrame([(*r, "") for r in rows], SCHEMA).repartition(parts)))
            assert found.n == n and found.sums.tolist() == s and found.scatter.tolist() == want


def test_no_rank_no_rows(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25], ""), (2, [0.5, 0.25], "")], SCHEMA)
    assert W.whiten(one).collect() == [] and W.whiten(one.limit(0)).columns[0] == "vec_id"
    assert W.whiten(one.limit(0)).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 3.0], "") for i in range(10)], SCHEMA)
    got = W.whiten(line).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12
    huge = W.whiten(spark.createDataFrame([(i, [1e300 * (-1) ** i, float(i)], "") for i in range(5)], SCHEMA)).collect()
    assert len(huge) == 5 and all(r.deviation is None for r in huge)               # beyond a long


@pytest.mark.parametrize("d", [1, 2, 5, 17, 40])
def test_factors(d):
    rng = np.random.RandomState(d)
    a = rng.normal(size=(3 * d, d)) * 10.0 ** rng.uniform(-4, 2, d)
    v = a.T @ a
    order, low = W.pivoted_cholesky(v)
    assert np.allclose(low @ low.T, v[np.ix_(order, order)], rtol=1e-10, atol=1e-12 * v.max())
    assert np.allclose(np.triu(low, 1), 0)
    values, columns = W.jacobi(low)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:len(values)], rtol=1e-8)
    assert np.allclose(columns.T @ columns, np.eye(len(values)), atol=1e-12)
    met = [tuple(sorted(p)) for x, y in W._meetings(d) for p in zip(x.tolist(), y.tolist())]
    assert sorted(met) == [(i, j) for i in range(d) for j in range(i + 1, d)]
