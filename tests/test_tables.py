import random
import time

import numpy as np
from pyspark.sql import functions as F

from tidewell.operators import layout, tables

SHAPE = tables.Shape([100.0, 200.0, 300.0], ["no", "name", "level", "owner"], ("level", "国家级|省级"), ("no", "[AB]类|项目", [("A", "A类"), ("B", "B类")]), "^[一二三]、(.+)$", "^第\\d+页$", ["no"])


def best_cut(values, centres):
    """The least cost over all ways to cut the values into runs, by trying them all."""
    n, k = len(values), len(centres)
    if n < k:
        return list(range(n))
    best = None

    def go(start, left, cost, ends):
        nonlocal best
        if not left:
            if start == n and (best is None or cost < best[0] - 1e-9):
                best = (cost, ends)
            return
        for end in range(start + 1, n - left + 2):
            go(end, left - 1, cost + abs(sum(values[start:end]) / (end - start) - centres[k - left]), [*ends, end])

    go(0, k, 0.0, [])
    return [sum(i >= e for e in best[1]) for i in range(n)]


def page(rng, doc, number, rows, sections):
    """Fragments of a page, and the rows that they are of."""
    frags, want, y, section = [], [], 800.0, None
    for i in range(rows):
        if i in sections:
            frags += [(doc, number, y, 20.0, "一"), (doc, number, y + 0.5, 30.0, "、"), (doc, number, y - 0.5, 40.0, f"节{number}{i}")]
            section = f"节{number}{i}"
            y -= 47
        name, owner = [f"n{number}{i}{c}" for c in "ab"[: rng.randrange(1, 3)]], [f"o{number}{i}{c}" for c in "abc"[: rng.choice([1, 3])]]
        for column, parts in ((120.0, name), (320.0, owner)):
            for j, t in enumerate(parts):
                frags.append((doc, number, y + 5 * (len(parts) - 1) - 10 * j, column, t))
        frags += [(doc, number, y, 220.0, rng.choice(["国家级", "省级"])), (doc, number, y + 0.7, 12.0, str(i + 1))]
        want.append((doc, number, i + 1, section, "".join(name), frags[-2][4], "".join(owner), str(i + 1), y))
        y -= 60
    for part in (("A类", want[: rows // 2]), ("B类", want[rows // 2 :])):
        if part[1]:
            middle = (part[1][0][-1] + part[1][-1][-1]) / 2
            frags += [(doc, number, middle + 9.3, 80.0, part[0]), (doc, number, middle - 9.3, 80.0, "项目")]
    return [*frags, (doc, number, 10.0, 150.0, f"第{number}页")], [w[:-1] + (("A类" if i < rows // 2 else "B类"),) for i, w in enumerate(want)]


def test_pages(spark):
    rng = random.Random(2)
    frags, want = [], []
    for doc in "ab":
        for number in range(1, 6):
            f, w = page(rng, doc, number, rng.randrange(2, 9), {0, 3} if number % 2 else set())
            frags, want = frags + f, want + w
    frags += [("a", 9, 50.0, 120.0, "no anchor"), ("a", 1, None, 1.0, "x"), ("a", 1, 5.0, None, "x")]
    df = spark.createDataFrame(frags, "doc string, page int, y double, x double, text string").repartition(3)
    key = lambda r: (r.doc, r.page, r.row)
    got = [(r.doc, r.page, r.row, r.section, r.name, r.level, r.owner, r.no, r.category) for r in sorted(tables.assemble(df, SHAPE).collect(), key=key)]
    assert got == sorted(want, key=lambda w: w[:3])
    carried = {(r.doc, r.page, r.row): r.section for r in tables.assemble(df, SHAPE, carry=True).collect()}
    last = None
    for w in sorted(want, key=lambda w: w[:3]):
        last = w[3] or (last if w[:2] != (w[0], 1) or last else None)
        if w[1] > 1 or w[3]:
            assert carried[w[:3]] == last


def test_partition_to(spark):
    rng = random.Random(3)
    rows = [([float(rng.randrange(100)) for _ in range(rng.randrange(0, 8))], [float(rng.randrange(100)) for _ in range(rng.randrange(0, 5))]) for _ in range(200)]
    rows = [(sorted(v, reverse=True), sorted(c, reverse=True)) for v, c in rows]
    df = spark.createDataFrame(rows, "v array<double>, c array<double>")
    for v, c, g in df.select("v", "c", layout.partition_to(F.col("v"), F.col("c"))).collect():
        cost = lambda groups: sum(abs(np.mean([x for x, y in zip(v, groups) if y == i]) - c[i]) for i in range(len(c)))
        if c and len(v) >= len(c):
            assert sorted(set(g)) == list(range(len(c))) and list(g) == sorted(g) and abs(cost(g) - cost(best_cut(v, c))) < 1e-9
        else:
            assert list(g) == ([] if not c else list(range(len(v))))


def test_lines_and_folds(spark):
    df = spark.createDataFrame([("p", float(5000 - i // 2), float(i), f"{i}") for i in range(6000)], "page string, y double, x double, text string")
    assert layout.same_lines(df, "page", "y", "x", "text", 2.0).count() == 1000
    rng = random.Random(4)
    for _ in range(200):
        line = "".join(rng.choice("ab,é中🙂") for _ in range(rng.randrange(0, 120)))
        parts = layout.fold(line).split("\r\n ")
        assert "".join(parts) == line and all(len(p.encode()) + (i > 0) <= 75 for i, p in enumerate(parts))
        assert all(len((p + q[0]).encode()) + (i > 0) > 75 for i, (p, q) in enumerate(zip(parts, parts[1:])))


def test_long_rows():
    """As all cuts tell for short rows of any order; a page of 960 rows took 73 s."""
    rng = np.random.default_rng(5)
    for turn in range(300):
        k = int(rng.integers(1, 5))
        values, centres = rng.integers(0, 20, int(rng.integers(k + 1, 9))).astype(float), rng.integers(0, 20, k).astype(float)
        if turn % 3:
            values, centres = np.sort(values)[:: 3 - 2 * (turn % 3)], np.sort(centres)[:: 3 - 2 * (turn % 3)]
        assert layout.long_partition(values, centres).tolist() == layout.monotone_partition(values[None], centres)[0].tolist()
    at = -60.0 * np.arange(1000)
    began = time.time()
    assert (layout.monotone_partition(np.sort(np.concatenate([at + 5, at - 5]))[None, ::-1], at + 0.5)[0] == np.arange(2000) // 2).all()
    assert time.time() - began < 10


def test_long_page(spark):
    """What stands in a row isn't looked for among all lines of the page."""
    frags = [("a", 1, -60.0 * i + dy, x, t) for i in range(1500) for dy, x, t in ((0.7, 12.0, str(i)), (5.0, 120.0, "n"), (-5.0, 120.0, str(i)), (0.0, 220.0, "国家级"), (0.0, 320.0, f"o{i}"))]
    df = spark.createDataFrame(frags, "doc string, page int, y double, x double, text string")
    began = time.time()
    got = sorted((r.row, r.no, r.name, r.owner) for r in tables.assemble(df, SHAPE).collect())
    assert got == [(i + 1, str(i), f"n{i}", f"o{i}") for i in range(1500)]
    assert time.time() - began < 60
