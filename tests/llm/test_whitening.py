import math
from decimal import Decimal

import numpy as np
import pytest

from hearthlake.llm import whitening as W


def table(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, "c", 1.0) for i, v in rows], f"vec_id bigint, embedding array<{kind}>, x string, n double")


def vectors(n=300, width=9, seed=4):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, width)) @ rng.standard_normal((width, width))).tolist()


def by_hand(rows, components=16):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in kept]
    fit = sorted({tuple(v) for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    u = np.array([[n * a - s for a, s in zip(v, sums, strict=True)] for v in fit], dtype=object)
    width = len(sums)
    v = np.array([[int((u[:, i] * u[:, j]).sum()) / n**3 for j in range(width)] for i in range(width)])
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    out = {}
    for i, a in x:
        own = [n * c - s for c, s in zip(a, sums, strict=True)]
        z = (np.array(own, float) / n) @ axes / np.sqrt(np.maximum(values, 1e-300))
        out.setdefault(i, []).append((n, sum(c * c for c in own), np.abs(z), values / np.trace(v)))
    return out


def check(got, want, components):
    assert len(got) == components * sum(map(len, want.values()))
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, []).append(r)
    for i, rows in by_id.items():
        for k in range(1, components + 1):
            have = sorted((r.n, int(r.deviation_exact), round(abs(r.whitened), 6), round(r.explained, 9)) for r in rows if r.component == k)
            assert have == sorted((n, d, round(z[k - 1], 6), round(e[k - 1], 9)) for n, d, z, e in want[i])
    assert {r.identity_error for r in got}.pop() < 1e-8 and len({r.identity_error for r in got}) == 1
    assert all(r.deviation is None or r.deviation == r.deviation_exact for r in got)


@pytest.mark.parametrize("width", [1, 9, 20])
def test_whitening_against_brute_force(spark, staging, width):
    rows = list(enumerate(vectors(width=width)))
    rows += [(1000, rows[0][1]), (1000, rows[1][1]), (None, rows[0][1]), (7, rows[7][1])]
    rows += [(2000, None), (2001, []), (2002, [None] * width), (2003, [math.nan] * width), (2004, [math.inf] + [0.0] * (width - 1))]
    got = W.whitening_report(staging, table(spark, rows).repartition(5)).collect()
    check(got, by_hand(rows), min(16, width))


def test_float_vectors_and_a_hot_one(spark, staging):
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(vectors(60, 5))] + [(i, [0.5, 0.25, 1.0, -1.0, 0.0]) for i in range(100, 400)]
    got = W.whitening_report(staging, table(spark, rows, "float")).collect()
    check(got, by_hand(rows), 5)
    assert {r.n for r in got} == {61}


def test_no_spread(spark, staging):
    for rows in ([(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [0.0, 5.0]), (2, [1.0, 5.0])]):
        got = W.whitening_report(staging, table(spark, rows)).collect()
        spread = len({tuple(v) for _, v in rows}) > 1
        assert len(got) == 2 * len(rows)
        assert all((r.whitened is None) == (r.component == 2 or not spread) for r in got)
        assert all(r.identity_error < 1e-9 for r in got)


def test_empty_tables(spark, staging):
    assert W.whitening_report(staging, table(spark, [])).count() == 0
    got = W.whitening_report(staging, table(spark, [(1, None), (2, [])]))
    assert got.count() == 0 and got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_lengths_that_differ_and_huge_entries_are_errors(spark, staging):
    with pytest.raises(ValueError, match="lengths"):
        W.whiten(staging, table(spark, [(1, [1.0]), (2, [1.0, 2.0])]))
    with pytest.raises(Exception, match="too large"):
        W.whiten(staging, table(spark, [(1, [1e300, 0.0]), (2, [1.0, 2.0])]))


def test_a_deviation_beyond_64_bits_is_kept_exact(spark, staging):
    rows = [(i, [float(i * 10**9), 1.0]) for i in range(40)]
    got = W.whitening_report(staging, table(spark, rows)).collect()
    want = by_hand(rows)
    far = [r for r in got if r.deviation is None]
    assert far and all(r.deviation_exact == Decimal(want[r.vec_id][0][1]) for r in got)


@pytest.mark.parametrize("bits", [20, 30, 55, 61])
def test_squares_are_exact(bits):
    rng = np.random.default_rng(bits)
    sums = W.Squares(3, -(-(bits + 1) // W.LIMB))
    total = [0, 0, 0]
    for _ in range(3):
        values = rng.integers(-(1 << bits), 1 << bits, (W.ROWS, 3))
        values[0] = [-(1 << bits), (1 << bits) - 1, 0]
        sums.add(values, slice(0, 3))
        total = [t + sum(int(v) ** 2 for v in values[:, c]) for c, t in enumerate(total)]
    assert sums.totals() == total


def test_differences_of_variances_are_the_covariance():
    x = np.random.default_rng(1).integers(-50, 50, (40, 4))
    n, u = 40, 40 * x - x.sum(axis=0)
    squares = {(i, j): int((u[:, i] ** 2).sum() if i == j else ((u[:, i] + u[:, j]) ** 2).sum()) for i in range(4) for j in range(i, 4)}
    assert np.allclose(W.covariance(n, squares, 4), np.cov(x.T, bias=True), rtol=1e-14, atol=1e-12)
