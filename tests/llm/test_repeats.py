import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import suffix_dedup
from tidewell.llm.induced_sort import InducedSort
from tidewell.llm.substring_dedup import remove_repeats


def corpus(seed, unit, sizes):
    rng = random.Random(seed)
    passages = [[unit(rng) for _ in range(n)] for n in sizes]
    rows = []
    for i in range(60):
        out = [unit(rng) for _ in range(rng.choice([0, 3, 40, 120]))]
        for _ in range(rng.choice([0, 1, 2, 3])):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 3)
            out += p[a : len(p) - rng.randrange(len(p) // 3)] + [unit(rng) for _ in range(rng.choice([0, 1, 30]))]
        if rng.random() < 0.15:
            out += [unit(rng)] * rng.choice([30, 300])
        rows.append((i, out))
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(7, rows[8][1]), (200, [])]
    rng.shuffle(rows)
    return rows


def brute_words(rows, width):
    first = {}
    for d, words in rows:
        for i in range(len(words) - width + 1):
            w = tuple(words[i : i + width])
            first[w] = min(first.get(w, d), d)
    out = []
    for d, words in rows:
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if first[tuple(words[i : i + width])] < d:
                gone[i : i + width] = [True] * width
        out.append((d, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g).encode()))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, seed):
    rows = corpus(seed, lambda r: r.choice("abcdefgh") + r.choice("xyzé"), [60, 90, 200])
    docs = spark.createDataFrame([(d, "  ".join(w)) for d, w in rows], "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n, r.removed, bytes(r.kept)) for r in remove_repeats(docs).collect())
    assert got == brute_words(rows, 50)


def test_words_edges(spark):
    text = " ".join(map(str, range(80)))
    docs = spark.createDataFrame([(1, None), (2, ""), (None, text), (5, text), (5, text), (6, text)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n, r.removed) for r in remove_repeats(docs).collect())
    assert got == [(-1, 80, 0), (1, 0, 0), (2, 0, 0), (5, 80, 0), (5, 80, 0), (6, 80, 80)]
    assert remove_repeats(docs.filter(F.lit(False))).count() == 0


def test_suffix_order():
    rng = np.random.default_rng(5)
    for letters in (1, 2, 3, 20):
        for n in (1, 2, 3, 10, 57, 400):
            for memory in (0, 1 << 20):
                text = rng.integers(1, letters + 1, n).astype(np.uint16)
                got = InducedSort(text, n, memory).order().tolist()
                assert got == sorted(range(n), key=lambda i: text[i:].tolist()), (letters, n)


def brute_bytes(rows, width):
    seen = {}
    for r, (_, t) in enumerate(rows):
        for i in range(len(t) - width + 1):
            seen.setdefault(t[i : i + width], []).append((r, i))
    gone = [bytearray(len(t)) for _, t in rows]
    for places in seen.values():
        if len(places) > 1:
            for r, i in places:
                gone[r][i : i + width] = b"\1" * width
    out = []
    for (d, t), g in zip(rows, gone):
        runs = sum(1 for i in range(len(g)) if g[i] and (i == 0 or not g[i - 1]))
        out.append((d, len(t), sum(g), runs, bytes(c for c, x in zip(t, g) if not x)))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bytes(spark, seed):
    rows = [(d, " ".join(w)) for d, w in corpus(seed, lambda r: r.choice("abcdefgh") + r.choice("xyzé") * r.choice([1, 4]), [30, 60, 90, 200])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = suffix_dedup.remove_repeats(docs)
    got = sorted((r.doc_id, r.n, r.removed, r.spans, bytes(r.kept)) for r in made.collect())
    assert got == brute_bytes([(d, t.encode()) for d, t in rows], 200)


def test_bytes_edges(spark):
    text = "".join(map(str, range(200)))
    docs = spark.createDataFrame([(1, None), (2, ""), (None, text), (5, text + "x"), (6, "q" * 5000), (7, "ab" * 99)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n, r.removed, r.spans) for r in suffix_dedup.remove_repeats(docs).collect())
    assert got == [(-1, 490, 490, 1), (1, 0, 0, 0), (2, 0, 0, 0), (5, 491, 490, 1), (6, 5000, 5000, 1), (7, 198, 0, 0)]
    assert suffix_dedup.remove_repeats(docs.filter(F.lit(False))).count() == 0


def test_unlike_strings_with_one_digest_stop_the_query(spark):
    from tidewell.llm.windows import one_kind

    df = spark.createDataFrame([(5, 1, 1), (5, 1, 2)], "digest long, low int, high int")
    with pytest.raises(Exception, match="one 64-bit digest"):
        df.select(one_kind("low", "high")).collect()
