import random
import zlib

import pytest

from tidewell.llm.toxicity import THRESHOLD, best_threshold, fit, score, train

BAD = ["blorn", "snarf", "grotting"]


def corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choices("aeioubcdfg", k=5)) for _ in range(rng.randint(10, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_learns_and_holds_out(spark):
    rows = corpus(1200, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows] + [(7, None), (None, 1), (99999, 1)], "doc_id long, toxic int")
    model = train(docs, labels)
    got = {r.doc_id: r.toxicity for r in score(docs, model).collect()}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((got[i] >= THRESHOLD) == y for i, y in held)
    assert right >= 0.95 * len(held)


def test_edges(spark):
    model = fit([(t.encode(), int(y)) for _, t, y in corpus(300, 2)], epochs=2)
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "word " * 50_000, "x"), (None, "a b", "x")], "doc_id long, text string, toxicity string")
    with pytest.raises(ValueError):
        score(docs, model)
    got = {r.doc_id: r.level for r in score(docs, model, "level").collect()}
    assert {r.toxicity for r in score(docs, model, "level").collect()} == {"x"}
    assert len(got) == 4 and all(0 <= v <= 1 for v in got.values()) and got[1] == got[2]
    assert fit([]).scores([b"a"])[0] < THRESHOLD


def test_threshold():
    import numpy as np

    assert best_threshold(np.array([0.0, 1.0, 4.0, 5.0]), np.array([0, 0, 1, 1])) == pytest.approx(2.5)
