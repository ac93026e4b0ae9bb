import random

import numpy as np

from tidewell.llm.top_k import ImpactIndex, search


def brute(rows, queries, k):
    ok = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v)
    ints = lambda v: [int(np.floor(64.0 * x)) for x in v]
    out, least = [], {}
    for q, e in queries:
        if q is not None and ok(e):
            least[q] = min(least.get(q, e), e)
    for q, e in least.items():
        if q is None or not ok(e):
            continue
        scored = sorted((-sum(a * b for a, b in zip(ints(e), ints(v))), i) for i, v in rows if i is not None and i != q and ok(v))
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_same_as_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(300)]
    rows += [(300 + i, rows[i % 7][1]) for i in range(60)]  # ties
    rows += [(400, None), (420, [None] * 12), (440, [float("nan")] + [0.0] * 11), (460, [float("inf")] + [0.0] * 11), (480, []), (500, [3e4] * 12), (None, [0.1] * 12), (520, [0.0] * 12)]
    queries = [r for r in rows if r[0] is not None and r[0] % 20 == 0]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for k, block, group in ((20, 8192, 1024), (5, 50, 4)):
        got = sorted(tuple(r) for r in search(df, df.filter("vec_id % 20 = 0"), k, block, group).collect())
        assert got == brute(rows, queries, k)


def test_few_and_none(spark):
    df = spark.createDataFrame([(20, [1.0, 2.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in search(df, df.filter("vec_id = 20")).collect()] == [(20, 1, 1, 64 * 32 + 128 * 32)]
    assert search(df.filter("false"), df).count() == 0
    assert search(df, df.filter("false")).count() == 0


def test_large_components(spark):
    rng = random.Random(3)
    for top in (1 << 23, 1 << 24, 1 << 20):
        rows = [(i, [float(rng.randrange(-top, top)) for _ in range(16)]) for i in range(120)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = sorted(tuple(r) for r in search(df, df.filter("vec_id % 20 = 0"), 10, 50, 4).collect())
        assert got == brute(rows, [r for r in rows if r[0] % 20 == 0], 10)


def test_repeated_queries(spark):
    rng = random.Random(4)
    rows = [(i % 40, [rng.gauss(0, 1) for _ in range(4)]) for i in range(60)]
    rows += rows[:21]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in search(df, df.filter("vec_id % 20 = 0"), 20, 30, 4).collect())
    assert got == brute(rows, [r for r in rows if r[0] % 20 == 0], 20) and len(got) == 40


def test_groups_same_as_one_by_one():
    """With floors from other blocks, own rows, ties, zero queries, and queries too large for the group's sums."""
    rng = np.random.default_rng(5)
    for top, n in ((40, 300), (1 << 12, 300), (1 << 24, 120), (3, 40)):
        x = rng.integers(-top, top, (n, 9))
        x[n // 2 :: 7], x[3] = x[1], 0
        ids = rng.permutation(n) // 2
        index = ImpactIndex(ids, x)
        queries = np.concatenate([x[:: 5], np.zeros((1, 9), np.int64), x[:1] * (1 << 20)])
        owns = np.append(ids[::5], [10**6, ids[0]])
        for k in (1, 5, 400):
            least = [None if i % 2 else int(v) for i, v in enumerate(rng.integers(-top * top, top * top, len(queries)))]
            got = index.search_all(queries, owns, k, least)
            for q, own, floor, (found, scores) in zip(queries, owns, least, got):
                a, b = index.search(q, int(own), k, floor)
                keep = slice(None) if floor is None else b >= floor
                mine = slice(None) if floor is None else scores >= floor
                assert found[mine].tolist() == a[keep].tolist() and scores[mine].tolist() == b[keep].tolist()
