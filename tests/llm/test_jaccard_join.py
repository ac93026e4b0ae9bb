import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import jaccard_join
from tidewell.llm.jaccard_join import allocation, edges_of_bands, keep_one, link, signatures


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefg", k=3))
    passage = [word() for _ in range(30)]
    rows = []
    for size in [0, 1, 2, 4, 5, 6, 7, 8, 9, 10, 12, 14, 18, 25, 40, 60, 80, 120, 200, 400, 900]:
        for _ in range(3):
            base = [word() for _ in range(size)]
            if size > 40 and rng.random() < 0.7:
                base[10:10] = passage
            for _ in range(rng.choice([1, 2, 4, 20])):
                text = list(base)
                for _ in range(rng.choice([0, 0, 1, 1, 2, max(1, size // 60), max(1, size // 30)])):
                    if text:
                        i = rng.randrange(len(text))
                        rng.choice([lambda: text.pop(i), lambda: text.insert(i, word()), lambda: text.__setitem__(i, word()), lambda: text.append(word())])()
                rows.append(" ".join(text))
    rng.shuffle(rows)
    return [(1000 - i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in link(docs).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute(rows)


def test_edges(spark):
    long = " ".join(str(i % 977) for i in range(60_000))
    rows = [(1, None, 1), (2, "", 1), (3, " \n", 1), (4, "a b c", 1), (5, "a b c", 1), (5, "a b c", 1), (None, "a b c", 1), (7, long, 1), (6, long + " x", 1), (None, "z", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted(((r.doc_id or -1, r.component_id or -1) for r in link(docs).collect()))
    assert got == [(-1, -1), (-1, 4), (1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (5, 4), (6, 6), (7, 6)]
    assert sorted((r.doc_id or -1) for r in keep_one(docs).collect()) == [-1, -1, 1, 2, 3, 4, 6]
    assert link(docs.filter(F.lit(False))).count() == 0


def test_tiny_tables(spark):
    for rows in ([(3, "a b c")], [(1, "x"), (2, "y"), (3, None)], [(1, "p q"), (2, "p q"), (3, "r s t u v w")], [(9, "a b"), (8, "a c"), (7, "")]):
        got = link(spark.createDataFrame(rows, "doc_id long, text string"))
        assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == brute(rows)


def test_many_near_copies(spark):
    """Lists far longer than one place holds, of copies of which some link only through others, and two bases that are
    a little too far from each other."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    base = [word() for _ in range(90)]
    other = list(base)
    for i in (10, 40, 70, 85):
        other[i] = word()
    rows = []
    for i in range(1000):
        text = list(base if i % 3 else other)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            text[rng.randrange(len(text))] = word()
        rows.append((5000 - i, " ".join(text)))
    old, jaccard_join.PART = jaccard_join.PART, 100
    try:
        got = link(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
        assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == brute(rows)
    finally:
        jaccard_join.PART = old


def test_letter_case(spark):
    text = " ".join(f"w{i} xé" for i in range(40))
    rows = [(1, text), (2, text.title().replace("É", "é")), (3, "X " + text.replace("w", "W")), (4, text.replace("é", "É")), (5, "a B c d e A b C d E"), (6, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link(docs).collect()}
    assert got[1] == got[2] == (76, 1) and got[3] == (77, 1)
    assert got[4] == (76, 4) and got[5] == (5, 5) and got[6] == (1, 6)
    assert sorted(r.doc_id for r in keep_one(docs).collect()) == [1, 4, 5, 6]


def test_every_similar_pair_shares_a_signature():
    rng = np.random.default_rng(3)
    for n in [1, 3, 5, 8, 9, 10, 13, 19, 30, 47, 73, 115, 180, 300]:
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64))
            swap = n // 9 if rng.random() < 0.5 else 0
            b = np.unique(np.concatenate([a[swap:], rng.integers(0, 1 << 63, swap, dtype=np.int64).astype(np.uint64)]))
            b = b[: len(b) - (n // 5 if not swap else 0)]
            common = len(np.intersect1d(a, b))
            if 100 * common >= 80 * (len(a) + len(b) - common):
                s, _, row, which, _, _ = signatures([a, b], 80, 100)
                assert np.intersect1d(s[which[row] == 0], s[which[row] == 1]).size


def test_allocation_pays():
    for band in range(15):
        segments, wide = allocation(band, 80, 100)
        assert segments + wide >= (int(edges_of_bands()[band + 1]) - 1) * 2 // 9 + 1
