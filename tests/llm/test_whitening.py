"""Whitened embeddings against a library's eigenvectors; spectrum slicing on hard spectra."""

import math

import numpy as np
import pytest

from lakeloom.llm import whitening
from lakeloom.llm.common import load
from lakeloom.llm.queries import QUERIES
from lakeloom.llm.spectrum import inertia, leading

RNG = np.random.default_rng(3)
TURN = np.linalg.qr(RNG.standard_normal((40, 40)))[0]
SPECTRA = {
    "spread": np.linspace(9, 1, 40),
    "equal": [2.0] * 40,
    "groups": [5.0] * 3 + [4.0] * 10 + [1.0] * 27,
    "close": [5.0, 5 - 1e-10, 5 - 2e-10, 5 - 1e-13, *np.linspace(2, 1, 36)],
    "narrow": np.linspace(1, 1 + 1e-8, 40),
    "two": [3.0, 2.0] + [0.0] * 38,
    "none": [0.0] * 40,
    "both signs": np.linspace(3, -3, 40),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_leading(name):
    a = TURN @ np.diag(SPECTRA[name]) @ TURN.T
    a = (a + a.T) / 2
    values, vectors = leading(a, 32)
    size = np.linalg.norm(a) or 1.0
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:32]).max() < 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(32)).max() < 1e-12
    assert np.linalg.norm(a @ vectors - vectors * values) < 1e-12 * size


def test_inertia():
    assert inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == (1, 0)
    assert inertia(np.diag([3.0, -2.0, 0.0, -1.0])) == (2, 1)


def brute(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    z = x * n - s
    y = z / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    return n, (z * z).sum(axis=1), y, e[::-1], u[:, ::-1], np.trace(v)


def same(rows, ids, vectors, count):
    n, deviation, y, e, u, trace = brute(vectors)
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) == len(ids) * count
    for k in range(count):
        want = y @ u[:, k] / math.sqrt(e[k])
        mine = np.array([got[i, k + 1].whitened for i in ids])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-6
    for i, d in zip(ids, deviation, strict=True):
        r = got[i, 1]
        assert (r.n, r.deviation) == (n, d) and r.identity_error < 1e-8
        assert abs(r.explained - e[0] / trace) < 1e-9


def test_table(spark, tables):
    rows = load(spark, tables, "embeddings").orderBy("vec_id").collect()
    got = QUERIES["op11_whitening"](spark, tables).collect()
    same(got, [r.vec_id for r in rows], [r.embedding for r in rows], 32)


FORM = "vec_id bigint, embedding array<float>, x string, n int, component int"


def test_odd_vectors(spark):
    good = RNG.standard_normal((30, 5)).astype(np.float32).tolist()
    odd = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(k, v, "x", 1, 2) for k, v in enumerate([*good, *odd])]
    got = whitening.whiten(spark.createDataFrame(rows, FORM)).collect()
    same(got, list(range(30)), good, 5)
    # A row that repeats is a vector more.
    twice = whitening.whiten(spark.createDataFrame([*rows, rows[0], (None, good[1], "x", 1, 2)], FORM)).collect()
    assert len(twice) == 32 * 5 and {r.n for r in twice} == {32}
    assert whitening.whiten(spark.createDataFrame([], FORM)).collect() == []
    assert whitening.whiten(spark.createDataFrame(rows[30:35], FORM)).collect() == []


def test_without_variance(spark):
    flat = [(k, [float(k), 1.0, float(-k)], "x", 1, 2) for k in range(4)]
    got = whitening.whiten(spark.createDataFrame(flat, FORM)).collect()
    assert {r.component for r in got if r.whitened is None} == {2, 3}
    assert all(r.identity_error < 1e-9 for r in got)
    got = whitening.whiten(spark.createDataFrame(flat[:1], FORM)).collect()
    assert [(r.deviation, r.whitened, r.identity_error) for r in got] == [(0, None, None)] * 3


def test_too_large(spark):
    rows = [(k, [3e38 * (-1) ** k, 1.0], "x", 1, 2) for k in range(3)]
    with pytest.raises(Exception, match="too large|overflow|OVERFLOW"):
        whitening.whiten(spark.createDataFrame(rows, FORM)).collect()
    assert whitening.exact_squares(np.array([[2**31, 2**31 - 1]])) == [2**62 + (2**31 - 1) ** 2]
