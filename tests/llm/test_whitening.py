from fractions import Fraction

import numpy as np
import pytest

from voltstream.llm.whitening import covariance, fit_whitening, op12_whitening, quantised, square_sums, whiten

SF = "/root/testdata/sf0.01"


def exact(xs):
    """(n, sums, covariance as fractions) of distinct integer vectors."""
    n, d = len(xs), len(xs[0])
    s = [sum(x[i] for x in xs) for i in range(d)]
    return n, s, [[sum(Fraction(n * x[i] - s[i]) * (n * x[j] - s[j]) for x in xs) / n ** 3 for j in range(d)] for i in range(d)]


def check(rows, got, components=4):
    """rows: (id, x); got: rows of whiten()."""
    n, s, cov = exact(sorted({x for _, x in rows}))
    v = np.array([[float(c) for c in r] for r in cov])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    by = {}
    for r in got:
        by.setdefault(r.component, {})[r.vec_id] = r
    assert sorted(by) == list(range(1, components + 1))
    for k, found in by.items():
        assert len(found) == len(rows)
        want = np.array([(np.array(x) - np.array(s) / n) @ vectors[:, k - 1] for _, x in rows]) / np.sqrt(values[k - 1])
        have = np.array([found[i].whitened for i, _ in rows])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-8
        for i, x in rows:
            r = found[i]
            assert (r.n, r.deviation) == (n, sum((n * a - b) ** 2 for a, b in zip(x, s)))
            assert abs(r.explained - values[k - 1] / np.trace(v)) < 1e-10 and r.identity_error < 1e-8


def test_query_against_brute_force(spark):
    raw = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [(r.vec_id, tuple(int(np.floor(256 * float(c))) for c in r.embedding)) for r in raw
            if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)]
    check(rows, op12_whitening(spark, SF).collect())


@pytest.mark.parametrize("spread", [3, 10 ** 6, 10 ** 9])
def test_covariances_are_exact(spark, spread):
    """Small integers, large ones, and ones for which 64 bits are too few."""
    rng = np.random.default_rng(spread)
    base = rng.integers(-spread, spread, (200, 5))
    xs = sorted({tuple(int(c) for c in x) for x in base + base[:, ::-1] // 2})
    fit = spark.createDataFrame([(list(x),) for x in xs], "x array<long>").repartition(3)
    n, s, cov = exact(xs)
    q = {(r.i, r.j): (int(r.high) << 60) + int(r.low) for r in square_sums(fit, n, s).collect()}
    assert q == {(i, j): sum(((n * x[i] - s[i]) + (n * x[j] - s[j]) * (i < j)) ** 2 for x in xs) for i in range(5) for j in range(i, 5)}
    assert covariance(fit, n, s).tolist() == [[float(c) for c in r] for r in cov]


def test_odd_vectors(spark):
    """NULL, empty, NULL entries, NaN, infinite, other lengths, huge entries; repeated vectors; clashing names."""
    rng = np.random.default_rng(5)
    good = [(i, [float(c) for c in rng.standard_normal(6)]) for i in range(40)]
    good += [(100 + i, good[0][1]) for i in range(30)]
    bad = [(200, None), (201, []), (202, [1.0] * 5 + [None]), (203, [1.0] * 5 + [float("nan")]), (204, [float("inf")] + [0.0] * 5), (205, [1.0] * 7), (206, [1e300] + [0.0] * 5)]
    data = spark.createDataFrame([(e, i, 7, "y") for i, e in good + bad], "embedding array<double>, vec_id long, n int, x string").repartition(4)
    got = whiten(spark, data).collect()
    check([(i, tuple(int(np.floor(256 * c)) for c in e)) for i, e in good], got)
    assert got[0].n == 40


def test_no_variance_and_empty(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], "vec_id long, embedding array<float>")
    assert whiten(spark, one).collect() == [] and whiten(spark, one.where("vec_id > 5")).collect() == []
    line = spark.createDataFrame([(i, [i / 4, i / 2, 0.0]) for i in range(9)] + [(None, [1.0, 2.0, 0.0])], "vec_id long, embedding array<double>")
    got = whiten(spark, line).collect()
    assert len(got) == 10 and {r.component for r in got} == {1} and all(abs(r.explained - 1) < 1e-12 for r in got)
    rows = quantised(spark, line)
    model, error = fit_whitening(spark, rows)
    assert model.n == 9 and error < 1e-12
