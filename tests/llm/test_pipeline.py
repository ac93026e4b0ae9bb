import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidewell.llm import suffix_dedup
from tidewell.llm.jaccard_join import keep_one
from tidewell.llm.secrets import compiled, in_code_points, RULES

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_columns_and_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert kept.columns == docs.columns
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert 0.7 * docs.count() < len(rows) < docs.count()
    # near duplicates
    sets = {d: shingles(t) for d, t in rows.items()}
    group = {d: d for d in rows}
    for a in sorted(rows):
        for b in sorted(rows):
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    rows = {d: t for d, t in rows.items() if group[d] == d}
    # repeated strings
    seen = {}
    raw = {d: (t or "").encode() for d, t in rows.items()}
    for d, t in raw.items():
        for i in range(len(t) - 199):
            seen.setdefault(t[i : i + 200], []).append((d, i))
    gone = {d: bytearray(len(t)) for d, t in raw.items()}
    changed = set()
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + 200] = b"\1" * 200
                changed.add(d)
    left = {d: bytes(c for c, g in zip(t, gone[d]) if not g).decode("utf-8", "ignore") for d, t in raw.items()}
    rows = {d: t for d, t in left.items() if d not in changed or t.strip()}
    # secrets
    for d, t in rows.items():
        spans = sorted((a, b) for a, _, b in in_code_points(t.encode(), compiled(RULES).scan(t.encode())))
        joined = []
        for a, b in spans:
            if joined and a < joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], b)
            else:
                joined.append([a, b])
        for a, b in reversed(joined):
            t = t[:a] + "[secret]" + t[b:]
        rows[d] = t
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for d, t in rows.items()}
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id: p.doc_tokens for p in pieces} == {d: len(x) for d, x in want.items()}
    for p in pieces:
        assert zlib.crc32(np.array(want[p.doc_id][p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32


def test_stages_with_odd_tables(spark):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, quality int, key long, spans string, secrets double, component_id string"
    clean, other = (" ".join(f"{k}{i} of the x{i}" for i in range(60)) for k in ("word", "thing"))
    more = (0.5, "c")
    rows = [(None, None, None, None, None, None, None, None, *more), (1, "", "en", "s", 0, 1, 2, "x", *more), (2, clean, "en", "s", 3, 1, 2, "x", *more), (2, clean, "en", "s", 3, 1, 2, "x", *more), (3, other + " token=abcdefghijkl", "xx", None, 3, 7, 8, None, *more), (None, "z" * 100_000, "en", "s", 3, 1, 2, "x", *more)]
    kept = {"quality_rules": [2, 2, 3], "jaccard_join": [2, 3], "suffix_dedup": [2, 3], "secret_scans": [2, 3]}
    for data in (rows, []):
        docs = spark.createDataFrame(data, kinds)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name == "packing":
                assert {r.doc_id for r in out.collect()} == ({2, 3} if data else set())
                continue
            assert out.schema.simpleString() == docs.schema.simpleString()
            docs = spark.createDataFrame(out.collect(), kinds)
            assert sorted(r.doc_id for r in docs.collect()) == (kept[name] if data else [])
            for r in docs.collect():
                want = next(x for x in rows if x[0] == r.doc_id)
                assert tuple(r)[2:4] + tuple(r)[5:] == want[2:4] + want[5:]
        if data:
            assert {r.doc_id: r.text for r in docs.collect()} == {2: clean, 3: other + " [secret]"}


def test_a_repeated_document_stays_once(spark):
    clean, other = (" ".join(f"{k}{i} of the {i * 7 % 31}" for i in range(60)) for k in ("word", "thing"))
    rows = [(2, clean, "a"), (2, clean, "a"), (5, clean, "b"), (2, other, "c"), (7, other, "d"), (7, other, "d"), (3, "", "e"), (3, "", "e"), (None, clean, "f"), (9, "lone", "g")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, key string").repartition(3)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.key for r in kept.collect()) == ["a", "c", "e", "e", "f", "g"]
    left = suffix_dedup.cut_repeats(kept.filter("doc_id is not null")).collect()
    assert sorted((r.doc_id, r.text) for r in left) == sorted([(2, clean), (2, other), (3, ""), (3, ""), (9, "lone")])


def test_cut_goes_through_no_character(spark):
    same = "é" * 150
    docs = spark.createDataFrame([(1, "a" + same + "b"), (2, "ĩ" + same)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in suffix_dedup.cut_repeats(docs).collect()}
    assert got[1] == "ab"
    assert got.get(2, "ĩ") == "ĩ"


@pytest.fixture(autouse=True)
def _quiet(spark):
    spark.sparkContext.setLogLevel("ERROR")
