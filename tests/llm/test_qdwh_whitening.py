"""Spectral divide and conquer and whitening against numpy's eigenvalues and plain sums."""

import math

import numpy as np
import pytest

from tally.llm import qdwh_whitening as Q

RNG = np.random.default_rng(3)


def spd(values):
    q = np.linalg.qr(RNG.standard_normal((len(values), len(values))))[0]
    return (q * values) @ q.T


MATRICES = [
    spd(np.sort(RNG.random(64))), spd(np.geomspace(1, 1e-14, 40)), spd(np.array([5.0] * 10 + [1.0] * 20 + [0.0] * 5)), np.diag([3.0, 1, 2, 2]),
    np.zeros((5, 5)), np.eye(7), np.array([[4.0]]), spd(1 + 1e-9 * RNG.random(12)), np.cov(RNG.standard_normal((8, 30)).T), spd(np.array([1e9, 1.0, 1.0, 1e-3])),
    np.array([[1.0, 1.0], [1.0, 1.0]]), spd(np.arange(1.0, 201.0)),
]


@pytest.mark.parametrize("a", MATRICES)
def test_components(a):
    values, rows = Q.spectral_components(a)
    scale = max(np.linalg.norm(a), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-13 * scale
    assert np.abs(rows @ rows.T - np.eye(len(a))).max() < 1e-12
    assert np.linalg.norm(a @ rows.T - rows.T * values) <= 2e-13 * scale * len(a) ** 0.5


def test_polar_factor():
    a = spd(np.array([3.0, -1e-6, 0.5, -2.0]))
    u = Q.polar(a)
    e, v = np.linalg.eigh(a)
    assert np.abs(u - (v * np.sign(e)) @ v.T).max() < 1e-8 and Q.polar(np.diag([1.0, 0.0])) is None


def brute(rows, k):
    """{id: (n, deviation, whitened up to sign, explained)} by numpy."""
    good = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    d = max(len(x) for _, x in good)
    good = [(i, x) for i, x in good if len(x) == d]
    fit = np.array(sorted({tuple(x) for _, x in good}))
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:k], v.T[::-1][:k]
    return [(i, n, sum((n * a - int(b)) ** 2 for a, b in zip(x, s, strict=True)), (np.array(x) - s / n) @ v.T / np.sqrt(e), e / np.trace(c.T @ c / n)) for i, x in good]


def test_whitening_rows(spark):
    base = RNG.standard_normal((60, 6)) * np.array([5, 3, 2, 1, 0.5, 0.2])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(100, rows[0][1]), (100, rows[0][1]), (None, rows[1][1]), (101, None), (102, []), (103, [1.0] * 5 + [None]),
             (104, [math.nan] * 6), (105, [math.inf] + [0.0] * 5), (106, [-0.0] * 6), (107, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, n int, x int").repartition(3)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    fit = Q.fit_whitening(df, components=4)
    got = sorted(fit.apply(df).collect(), key=lambda r: (-1 if r.vec_id is None else r.vec_id, r.x))
    want = sorted(brute(rows, 4), key=lambda r: -1 if r[0] is None else r[0])
    assert [r.vec_id for r in got] == [w[0] for w in want] and len(got) == 64
    white, ref = np.array([r.whitened for r in got]), np.array([w[3] for w in want])
    sign = np.sign((white * ref).sum(axis=0))
    assert np.abs(white - ref * sign).max() < 1e-9
    assert all((fit.n, r.deviation) == w[1:3] for r, w in zip(got, want, strict=True))
    assert np.abs(np.array(fit.explained()) - want[0][4]).max() < 1e-12 and fit.identity_error < 1e-9


def test_few_vectors_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.5, 3.0]), (3, [1.0, 2.0, 3.0])], "vec_id long, embedding array<double>")
    fit = Q.fit_whitening(df)
    assert fit.n == 2 and len(fit.values) == 1 and fit.explained() == [1.0]
    assert sorted(abs(r.whitened[0]) for r in fit.apply(df).collect()) == [1.0, 1.0, 1.0]
    same = Q.fit_whitening(df.filter("vec_id <> 2"))
    assert same.n == 1 and [(r.whitened, r.deviation) for r in same.apply(df.filter("vec_id <> 2")).collect()] == [([], 0), ([], 0)]
    empty = df.filter("1 = 0")
    assert Q.fit_whitening(empty).apply(empty).count() == 0
    big = spark.createDataFrame([(1, [2.0**50, 0.0]), (2, [-(2.0**50), 1.0])], "vec_id long, embedding array<double>")
    assert [r.deviation for r in Q.fit_whitening(big).apply(big).collect()] == [None, None]


def test_query_on_the_driver_tables(spark):
    from tally.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    want = brute([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()], 4)
    got = {(r.vec_id, r.component): r for r in QUERIES["op11_qdwh_whitening"](spark, sf).collect()}
    assert len(got) == 4 * len(want)
    ref = np.array([w[3] for w in want])
    white = np.array([[got[w[0], c].whitened for c in (1, 2, 3, 4)] for w in want])
    assert np.abs(white - ref * np.sign((white * ref).sum(axis=0))).max() < 1e-9
    for i, n, deviation, _, explained in want:
        for c in (1, 2, 3, 4):
            r = got[i, c]
            assert (r.n, r.deviation) == (n, deviation) and abs(r.explained / explained[c - 1] - 1) < 1e-9 and r.identity_error < 1e-4
