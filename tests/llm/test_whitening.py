import math
from fractions import Fraction

import numpy as np
import pytest

from orderloom.llm import whitening

KIND = "vec_id long, embedding array<float>"


def brute(rows, k=4):
    """Exact sums and numpy's own eigenvectors."""
    used = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in used), default=0)
    scaled = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v) + (0,) * (d - len(v))) for i, v in used]
    fit = sorted({x for _, x in scaled})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[float(c - Fraction(s, n)) for c, s in zip(x, sums)] for x in fit])
    cov = y.T @ y / n
    e, w = np.linalg.eigh(cov)
    e, w = e[::-1][:k], w[:, ::-1][:, :k]
    out = [(i, n, sum((n * c - s) ** 2 for c, s in zip(x, sums)), np.array([float(c - Fraction(s, n)) for c, s in zip(x, sums)])) for i, x in scaled]
    return out, e, w, np.trace(cov)


def compare(spark, rows, kind=KIND):
    got = {}
    for r in whitening.report(spark.createDataFrame(rows, kind)).collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    want, e, w, trace = brute(rows)
    assert set(got) == {i for i, *_ in want}
    for i, n, deviation, y in want:
        for c in range(len(e)):
            r = got[i][c + 1]
            assert (r.n, r.deviation_digits) == (n, str(deviation)) and r.deviation == (deviation if deviation < 2**63 else None)
            assert abs(r.explained - e[c] / trace) <= 1e-9 * e[c] / trace + 1e-13
            if e[c] > 1e-9 * trace:
                assert r.identity_error < 1e-9
                assert abs(abs(r.whitened) - abs(y @ w[:, c]) / math.sqrt(e[c])) < 1e-7
    return got


def test_against_numpy(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 12)) * np.array([3, 2, 1.5, 1.4, 1, 1, 0.5, 0.4, 0.3, 0.2, 0.1, 0])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)] + [(1000 + i, [float(c) for c in base[i % 3]]) for i in range(200)]
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * 10), (2002, [float("nan")] * 12), (2003, [float("-inf")] * 12), (2004, [1.5, -2.0]), (2005, []), (2006, [-0.0] * 12)]
    got = compare(spark, rows)
    signs = {c: {np.sign(got[i][c].whitened) == np.sign(got[1000 + i][c].whitened) for i in range(3)} for c in range(1, 5)}
    assert all(s == {True} for s in signs.values())


def test_few_dimensions_and_equal_vectors(spark):
    assert {len(x) for x in compare(spark, [(1, [1.0, 2.0]), (2, [2.0, 5.0]), (3, [0.0, 1.0]), (4, [-0.001, 9.0])]).values()} == {2}
    same = whitening.report(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])], KIND)).collect()
    assert len(same) == 6 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained is None and r.identity_error is None for r in same)
    line = whitening.report(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(5)], KIND)).collect()
    assert all((r.whitened is None) == (r.component > 1) and r.identity_error < 1e-12 for r in line)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(np.float32(1e7 * i)), float(i * i)]) for i in range(40)]
    compare(spark, rows)
    model = whitening.Model(10**9, (3 * 10**10, -(10**10)), 255, np.ones(2), np.eye(2), 2.0, 0.0)
    x = np.array([[17, -255], [3, 4]])
    assert model.deviations(x) == [sum((10**9 * int(c) - s) ** 2 for c, s in zip(r, model.sums)) for r in x]


def test_empty(spark):
    for rows in ([], [(1, None), (2, [float("nan")])], [(1, [])]):
        df = whitening.report(spark.createDataFrame(rows, KIND))
        assert df.collect() == [] and df.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], "a", 7), (2, [0.0, 1.0], "b", 8), (3, None, "c", 9)], KIND + ", label string, WHITENED int")
    got = whitening.whiten(df, whitening.fit(df))
    assert got.columns == ["vec_id", "embedding", "label", "whitened", "deviation_digits"]
    assert {(r.vec_id, r.label, r.whitened is None, r.deviation_digits is None) for r in got.collect()} == {(1, "a", False, False), (2, "b", False, False), (3, "c", True, True)}


def test_counts_are_those_of_the_spectrum():
    rng = np.random.default_rng(3)
    for d in (1, 2, 3, 8, 40):
        for _ in range(20):
            a = rng.normal(size=(d, d)) * (rng.random((d, d)) < 0.5)
            a = a + a.T
            e = np.linalg.eigvalsh(a)
            for shift in rng.uniform(e[0] - 1, e[-1] + 1, 6):
                if np.abs(e - shift).min() > 1e-9:
                    assert whitening.above(a, shift) == (e > shift).sum()
    assert whitening.above(np.zeros((3, 3)), 0.0) == 0 and whitening.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


@pytest.mark.parametrize("spectrum", [[9, 5, 4, 1, 0.5], [5, 5, 5, 1, 0], [7, 7, 7, 7, 7], [3, 3 - 1e-8, 2, 2, 2], [1e9, 1, 1e-6, 0, 0], [4, 0, 0, 0, 0]])
def test_leading_pairs(spectrum):
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(5, 5)))[0]
    a = q @ np.diag(spectrum) @ q.T
    values, vectors = whitening.leading(a, 4)
    assert np.allclose(values, spectrum[:4], rtol=0, atol=1e-13 * spectrum[0])
    assert np.allclose(vectors.T @ vectors, np.eye(4), atol=1e-6)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * spectrum[0]
