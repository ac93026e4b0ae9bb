import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewell.llm.best_fit import Limits, fit, pack, place

CASES = [Limits(), Limits(tokens=50), Limits(tokens=50, documents=3), Limits(tokens=64, attention=900), Limits(tokens=64, documents=4, attention=1500, weights=(1.0, 0.5, 0.5)), Limits(tokens=64, documents=5, select="dot")]


def one_by_one(lengths, limits):
    """Best fit, a piece at a time."""
    whole = [int(x) for x in limits.capacity()]
    bins, out = [], []
    for length in sorted(lengths, reverse=True):
        need, best = [length, 1, length**2], None
        for i, left in enumerate(bins):
            if all(a >= b for a, b in zip(left, need)):
                if limits.select == "norm":
                    score = sum(w * ((a - b) / c) ** 2 for w, a, b, c in zip(limits.weights, left, need, whole))
                else:
                    score = -sum(w * a * b / c / c for w, a, b, c in zip(limits.weights, left, need, whole))
                if best is None or score < best[0] - 1e-15:
                    best = (score, i)
        if best is None:
            bins.append(whole[:])
            best = (0, len(bins) - 1)
        bins[best[1]] = [a - b for a, b in zip(bins[best[1]], need)]
        out.append((length, best[1]))
    return bins, out


@pytest.mark.parametrize("limits", CASES)
def test_same_as_one_by_one(limits):
    rng = random.Random(1)
    for n in (0, 1, 5, 60, 400):
        lengths = [min(limits.longest(), 1 + int(rng.expovariate(1 / 15))) for _ in range(n)]
        bins, want = one_by_one(lengths, limits)
        counts = {k: lengths.count(k) for k in lengths}
        runs = fit(counts, limits)
        got = {}
        for length, many in counts.items():
            found, offset = place(runs, np.full(many, length), np.arange(many))
            for b, o in zip(found.tolist(), offset.tolist()):
                got.setdefault(b, []).append((o, length))
        for inside in got.values():
            at = 0
            for o, length in sorted(inside):
                assert o == at
                at += length
            assert at <= limits.tokens and len(inside) <= limits.capacity()[1] and sum(k * k for _, k in inside) <= limits.capacity()[2]
        mine = sorted(tuple(sorted(k for _, k in x)) for x in got.values())
        theirs = {}
        for length, b in want:
            theirs.setdefault(b, []).append(length)
        assert mine == sorted(tuple(sorted(x)) for x in theirs.values()) and len(mine) == len(bins)


def test_many_of_few_lengths():
    """The driver's work goes by lengths: billions of pieces are as fast as few, and all sequences but a few are full."""
    rng = np.random.default_rng(1)
    counts = {n: int(rng.integers(1, 10**9)) for n in range(1, 2048)}
    runs = fit(counts, Limits())
    assert runs["pieces"].sum() == sum(counts.values())
    bins = int((runs["bin"] + -(-runs["pieces"] // runs["each"])).max())
    assert bins <= -(-sum(n * c for n, c in counts.items()) // 2048) * 1.02 and len(runs) < 60_000


def test_refused():
    with pytest.raises(ValueError):
        fit({70: 1}, Limits(tokens=64))
    with pytest.raises(ValueError):
        fit({1: 1}, Limits(select="other"))


@pytest.mark.parametrize("limits", [Limits(tokens=7), Limits(tokens=16, documents=2, attention=100), Limits()])
def test_pack(spark, limits):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["", None, "a", "one two three " * 7, "the quick brown fox", "### 中文 x\n\ny", "word " * 3000, "a", "a b", "one two three"]
    rows = [(100 - i, t) for i, t in enumerate(texts)] + [(3, "twice"), (3, "twice"), (None, "no name")] + [(1000 + i, "many alike") for i in range(40)]
    df = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, part int").repartition(3)
    whole, bins = {}, {}
    for r in pack(df, limits=limits).collect():
        assert len(r.ids) == 4 * r.length and r.start == r.piece * limits.longest()
        whole.setdefault(r.doc_id, []).append((r.piece, r.ids))
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d in {d for d, _ in rows}:
        same = [t for x, t in rows if x == d]
        want = np.array(tokenizer.encode(same[0] or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        cut = [want[i : i + 4 * limits.longest()] for i in range(0, len(want), 4 * limits.longest())]
        assert sorted(whole[d]) == sorted((i, x) for i, x in enumerate(cut) for _ in same)
    for inside in bins.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= limits.tokens and len(inside) <= limits.capacity()[1] and sum(k * k for _, k in inside) <= limits.capacity()[2]
    assert pack(df.filter("false"), limits=limits).count() == 0
