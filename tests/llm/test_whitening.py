import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tidewell.llm.whitening import WIDE, eigen, whiten

KIND = "vec_id long, embedding array<double>, component string"


def brute(rows, k):
    """By exact sums and a solver in float64."""
    ok = [(i, [math.floor(1024.0 * c) + 100000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(ok), len(ok[0][1])
    sums = [sum(x[j] for _, x in ok) for j in range(d)]
    exact = [[Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for _, x in ok), n**3) for j in range(d)] for i in range(d)]
    values, axes = np.linalg.eigh(np.array([[float(v) for v in row] for row in exact]))
    values, axes = values[::-1], axes[:, ::-1]
    out = {}
    for i, x in ok:
        apart = [n * v - s for v, s in zip(x, sums)]
        out.setdefault(i, []).append((n, sum(v * v for v in apart), [sum(v / n * a for v, a in zip(apart, axes[:, c])) / math.sqrt(values[c]) for c in range(min(k, d))]))
    return out, values / values.sum()


def test_same_as_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.1 * (j + 1)) + j for j in range(12)]) for i in range(200)]
    rows += rows[:5] + [(None, rows[7][1])]
    odd = [(300, None), (301, [None] * 12), (302, [float("nan")] + [0.0] * 11), (303, [float("-inf")] + [0.0] * 11), (304, []), (305, [1.0]), (306, [1e300] + [0.0] * 11)]
    df = spark.createDataFrame([(*r, "x") for r in rows + odd], KIND).repartition(3)
    want, explained = brute(rows, 8)
    got = {}
    for r in whiten(df).collect():
        got.setdefault((r.vec_id, r.deviation, r.n), {}).setdefault(r.component, []).append(r.whitened)
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
    assert {k[0] for k in got} == {i for i, _ in rows}
    signs = None
    for i, found in want.items():
        for n, deviation, cells in found:
            mine = got[i, deviation, n]
            assert sorted(mine) == list(range(1, 9)) and len(mine[1]) == len(found)
            signs = signs or [np.sign(mine[c + 1][0] * v) for c, v in enumerate(cells)]
            assert all(abs(mine[c + 1][0] - s * v) < 1e-9 for c, (v, s) in enumerate(zip(cells, signs)))


@pytest.mark.parametrize("gaps", [[1, 1, 1, 1, 1, 1], [1, 1 + 1e-9, 1 + 2e-9, 1 - 1e-13, 0.5, 0.5 + 1e-12], [1e6, 1e6 + 1e-4, 1, 1 + 1e-10, 1e-6, 2e-6], [3, 2, 1, 0, 0, 0]])
def test_clusters(gaps):
    """Vectors are right to double precision wherever eigenvalues differ; clusters span the right space anyhow."""
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(6, 6)))[0].astype(WIDE)
    for _ in range(4):
        q = q + q @ (np.eye(6) - q.T @ q) / 2
    a = (q * np.array(gaps, WIDE)) @ q.T
    a = (a + a.T) / 2
    values, x = eigen(a)
    assert np.abs(x.T @ x - np.eye(6)).max() < 1e-17 and (np.diff(values) <= 0).all()
    assert np.abs(values - np.sort(np.array(gaps, WIDE))[::-1]).max() <= 1e-16 * max(gaps)
    assert np.abs(a @ x - x * values).max() <= 4e-18 * max(gaps)


def test_few_and_none(spark):
    one = whiten(spark.createDataFrame([(1, [0.5, 0.25], "x")], KIND)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, 0.0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0, 0.0)]
    two = whiten(spark.createDataFrame([(1, [0.0, 5.0], "x"), (2, [1.0, 5.0], "x")], KIND)).collect()
    assert sorted((r.vec_id, r.component, abs(round(r.whitened, 12)), r.explained) for r in two) == [(1, 1, 1.0, 1.0), (1, 2, 0.0, 0.0), (2, 1, 1.0, 1.0), (2, 2, 0.0, 0.0)]
    big = whiten(spark.createDataFrame([(1, [1e12], "x"), (2, [-1e12], "x")], KIND)).collect()
    assert [r.deviation for r in big] == [None, None] and sorted(round(r.whitened, 9) for r in big) == [-1.0, 1.0]
    assert whiten(spark.createDataFrame([], KIND)).count() == 0 and whiten(spark.createDataFrame([(1, None, "x"), (2, [], "x")], KIND)).count() == 0
