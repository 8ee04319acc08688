"""Whitening: spectrum slicing against numpy's eigenvalues, exact integers, and the contract's result by brute force."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest

from loomcorpus.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def _random(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    m = q * np.array(values) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("seed", range(5))
def test_pivot_signs_count_eigenvalues(seed):
    m = np.random.default_rng(seed).integers(-3, 4, (13, 13)).astype(float)
    m = m + m.T
    np.fill_diagonal(m, 0)  # no pivot of one row to begin with
    e = np.linalg.eigvalsh(m)
    for s in np.linspace(e[0] - 1, e[-1] + 1, 37):
        assert whitening.positive_pivots(m - s * np.eye(13)) == (e > s).sum()
    assert whitening.positive_pivots(np.zeros((3, 3))) == 0


@pytest.mark.parametrize("values", [[9, 7, 5, 3, 1], [5, 5, 5, 1, 1, 0], [1, 1 - 1e-9, 1 - 2e-9, 0.5, 1e-6], [4, 0, 0], [1e12, 1, 1e-3], [2, 2, 2, 2], list(range(40, 0, -1))])
def test_leading_pairs(values):
    m = _random(values)
    e, x = whitening.leading(m, 16)
    want = [v for v in sorted(values, reverse=True) if v > whitening.ZERO * sum(values)][:16]
    assert len(e) == len(want) and np.allclose(e, want, rtol=0, atol=1e-13 * sum(values))
    assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-12 and np.abs(m @ x - x * e).max() < 1e-12 * sum(values)
    assert all(a >= b for a, b in zip(e, e[1:], strict=False))


def test_contract(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    good = [r for r in rows if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)]
    x = {r.vec_id: tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in r.embedding) for r in good}
    fit = np.array(sorted(set(x.values())), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    v = np.cov((fit - sums / n).T, bias=True)
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:16], axes[:, ::-1][:, :16]
    got = queries.QUERIES["op11_whitening"](spark, SF).collect()
    assert len(got) == 16 * len(good) and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10
    signs = {}
    for r in got:
        dev = [n * a - int(s) for a, s in zip(x[r.vec_id], sums, strict=True)]
        assert r.deviation == sum(a * a for a in dev)
        want = (np.array([float(Fraction(a, n)) for a in dev]) @ axes[:, r.component - 1]) / np.sqrt(e[r.component - 1])
        if abs(want) > 1e-3:
            signs.setdefault(r.component, np.sign(want * r.whitened))
        assert abs(want - signs.get(r.component, 1) * r.whitened) < 1e-8
        assert abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-10


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (2, [1.5, -1.0]), (None, [0.25, 3.0]), (3, None), (4, []), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, 2.0, 3.0]), (9, [1e5, 2.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, deviation int")
    out = whitening.whitened_components(df).collect()
    assert sorted((r.vec_id or 0, r.component) for r in out) == sorted((i, c) for i in (0, 1, 1, 2, 9) for c in (1, 2))
    xs = [(1_000_032, 1_000_064), (1_000_096, 999_936), (1_000_016, 1_000_192), (7_400_000, 1_000_128)]
    sums = [sum(c) for c in zip(*xs, strict=True)]
    want = {i: sum((4 * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for i, x in zip((1, 2, 0, 9), xs, strict=True)}
    assert all(r.deviation == want[r.vec_id or 0] for r in out)
    far = whitening.whitened_components(spark.createDataFrame([(1, [0.0]), (2, [1e9])], "vec_id long, embedding array<double>")).collect()
    assert [r.deviation for r in far] == [None, None] and {abs(r.whitened) for r in far} == {1.0}
    assert whitening.transform(df, whitening.fit(df)).columns == ["vec_id", "embedding", "deviation", "whitened"]


def test_no_directions(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whitened_components(same).count() == 0
    empty = whitening.whitened_components(same.limit(0))
    assert empty.count() == 0 and empty.columns == whitening.whitened_components(same).columns


def test_integers_beyond_doubles(spark):
    """Sums of products that doubles can't hold stay exact."""
    rows = [(i, [float(1 << 24) * i, float(i * i)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit(df)
    x = [[int(64 * c) + 1_000_000 for c in v] for _, v in rows]
    assert model.sums == tuple(sum(c) for c in zip(*x, strict=True)) and model.identity_error < 1e-4
