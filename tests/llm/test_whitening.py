from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylake.llm import queries as Q
from staylake.llm.whitening import _limbs, LIMB, deviations, scatter, whitened

from tests.conftest import SF_SMALL


def brute(rows, k=4):
    """``{row index: (deviation, whitened)}``, ``n``, shares: from the definition, sums as fractions."""
    ok = {i: v for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    x = {i: tuple(math.floor(256 * float(c)) for c in v) for i, v in ok.items()}
    fit = sorted(set(x.values()))
    n, d = len(fit), len(fit[0])
    s = [sum(v[j] for v in fit) for j in range(d)]
    mean = [Fraction(t, n) for t in s]
    cov = np.array([[float(sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in fit) / n) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = {i: (sum((n * a - b) ** 2 for a, b in zip(v, s)), (np.array(v) - np.array(s) / n) @ u / np.sqrt(e)) for i, v in x.items()}
    return out, n, e / np.trace(cov)


def same(rows, want, n, share):
    assert len(rows) == sum(len(w[1]) for w in want.values())
    got = {(r.vec_id, r.component): r for r in rows}
    sign = {}
    for (i, k), r in got.items():
        deviation, w = want[i]
        assert r.n == n and r.deviation == deviation
        assert r.explained == pytest.approx(share[k - 1], rel=1e-9)
        assert r.identity_error <= 1e-6
        if abs(w[k - 1]) > 1e-3:
            sign.setdefault(k, math.copysign(1, w[k - 1] * r.whitened))
        assert r.whitened * sign.get(k, 1) == pytest.approx(w[k - 1], abs=1e-6)


def test_query_against_the_definition(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    small = [(i, v[:7]) for i, v in rows[:150]]
    df = spark.createDataFrame(small, "vec_id long, embedding array<double>")
    same(whitened(df).collect(), *brute(small))
    got = Q.op12_embedding_whitening(spark, SF_SMALL).collect()
    want, n, share = brute(rows)
    same(got, want, n, share)
    w = np.zeros((len(want), 4))
    for r in got:
        w[sorted(want).index(r.vec_id), r.component - 1] = r.whitened
    assert np.abs(np.cov(w.T, bias=True) - np.eye(4)).max() < 1e-6  # no repeats in this table


def test_scatter_is_exact():
    rng = np.random.default_rng(3)
    for x in (
        rng.integers(-300, 300, (1000, 6)),
        rng.integers(-(2**62), 2**62, (70, 3)),
        np.array([[-(2**63), 2**63 - 1], [2**63 - 1, -(2**63)], [0, 5]]),
        np.full((64, 2), 7),
        np.zeros((1, 1), np.int64),
    ):
        x = x.astype(np.int64)
        s, c = scatter(x)
        o = x.astype(object)
        assert (s == o.sum(0)).all() and (c == o.T @ o).all()
        for v in c.ravel():
            assert sum(b << (LIMB * k) for k, b in enumerate(_limbs(int(v)))) == v


def test_deviations_are_exact_or_null():
    x = np.array([[3, -4], [100, 7]], np.int64)
    for n, s in ((5, (1, -2)), (10**7, (12345, -99999)), (3, (2**61, -(2**61)))):
        want = [sum((n * int(a) - b) ** 2 for a, b in zip(r, s)) for r in x]
        assert deviations(x, n, s) == [w if w < 2**63 else None for w in want]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    base = [(i, [float(i % 5), (i * i % 7) / 3, 0.5, float(i == 3)]) for i in range(12)]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [nan, 0.0, 0.0, 0.0]), (103, [inf, 0.0, 0.0, 0.0])]
    rows = base + bad + [(5, base[5][1]), (50, base[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.select("*", *[F.lit(0).alias(c) for c in ("x", "v", "n", "component", "i", "j", "l0", "whitened")])
    got = whitened(df).collect()
    want, n, share = brute([r for r in rows if r[0] not in (5,)] + [base[5]])
    one = [r for k, r in enumerate(got) if (r.vec_id, r.component) not in {(g.vec_id, g.component) for g in got[:k]}]
    assert len(share) == 4 and share[3] < 1e-12  # one dimension never varies: three components
    assert len(got) == 3 * 14 and {r.n for r in got} == {len({tuple(math.floor(256 * c) for c in v) for _, v in base})}
    same(one, {i: (d, w[:3]) for i, (d, w) in want.items()}, n, share)
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert whitened(empty).count() == 0
    assert whitened(spark.createDataFrame(bad, "vec_id long, embedding array<double>")).count() == 0
    assert whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")).count() == 0
    ragged = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (None, []), (4, [3.0, -1e300])], "vec_id long, embedding array<double>")
    got = whitened(ragged).collect()
    assert {r.vec_id for r in got} == {1, 2, None, 4} and len(got) % 4 == 0
