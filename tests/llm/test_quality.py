import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm.quality import COMMON_WORDS, OF_REFERENCE, assess, beyond, code_of, js_distance, share

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines, seen, repeated = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), n < 50 or 100 * len(covered) > 50 * n


def corpus():
    rng = random.Random(1)
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "fr", "EN-us", None])
        common = COMMON_WORDS["fr" if lang == "fr" else "en"]
        words = [rng.choice(common[:12]) if rng.random() < 0.4 else "".join(rng.choices("abcdeéfgh", k=rng.randint(2, 9))) for _ in range(rng.choice([5, 60, 300]))]
        text = re.sub(r"((?:\S+ ){9}\S+) ", r"\1.\n", " ".join(words))
        rows.append((i, text, lang))
    rows += [(200, " ".join(w.upper() + "!!" for w in rows[2][1].split()) * 3, "en"), (201, " | ".join("".join(rng.choices("xyz#", k=7)) for _ in range(200)), "en")]
    rows += [(202, "und " * 100, "de"), (203, None, "en"), (204, "", None), (204, "", None), (205, "a b\tc\x0bd\x0ce\r\n\x1cf a b\tc\x0bd\n" * 9, "en"), (206, "x" * 70_000, "en"), (207, "same line here\n" * 30, "zz")]
    return rows


def test_counts_and_verdicts(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string").withColumn("quality", F.lit(7)).repartition(3)
    with pytest.raises(ValueError):
        assess(docs)
    made = assess(docs, out="verdict")
    assert {r.quality for r in made.collect()} == {7}
    got = made.select("doc_id", "verdict.*").collect()
    want = {d: brute(t) for d, t, _ in rows}
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want[r.doc_id], r.doc_id
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[d] for d, t, _ in rows[:120] if not want[d][5])
    assert not kept[200] and not kept[201]
    assert assess(docs.filter(F.lit(False)), out="verdict").count() == 0


def test_distance():
    p, q = np.array([1.0, 0.0]), np.array([0.0, 1.0])
    assert js_distance(p, q) == pytest.approx(1) and js_distance(p, p) == 0
    a, b = share(np.array([3, 1, 0])), share(np.array([1, 1, 2]))
    m = (a + b) / 2
    divergence = sum(x * math.log2(x / y) for x, y in zip(a, m) if x) / 2 + sum(x * math.log2(x / y) for x, y in zip(b, m) if x) / 2
    assert js_distance(a, b) == pytest.approx(math.sqrt(divergence))
    assert not beyond(None, (0.0, 0.0), 1) and beyond(0.5, (0.3, 1.0), 100)
    assert [code_of(x) for x in ("EN_us", " fr ", None, "english", "x1")] == ["en", "fr", "und", "und", "und"]


def test_small_languages_are_judged_too(spark):
    """No number of documents switches the verdict off: what a reference allows for falls with its size, step by step."""
    limits = [(0.3**2 + OF_REFERENCE / n) ** 0.5 for n in (1, 2, 10, 29, 30, 31, 1000)]
    assert all(beyond(x + 1e-9, (0.3, 0.0), 1, n) and not beyond(x - 1e-9, (0.3, 0.0), 1, n) for x, n in zip(limits, (1, 2, 10, 29, 30, 31, 1000)))
    rng = random.Random(3)
    clean = [(i, " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(400)), "pl") for i in range(20)]
    junk = [(99, " ".join("".join(rng.choices("#$%&|<>*", k=7)) for _ in range(400)), "pl")]
    kept = {r.doc_id: r.quality.kept for r in assess(spark.createDataFrame(clean + junk, "doc_id int, text string, lang string")).collect()}
    assert not kept.pop(99) and all(kept.values())
