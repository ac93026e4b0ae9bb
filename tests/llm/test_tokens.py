import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm.bpe import codec, round_trip
from tidewell.llm.chunk_store import read_store, write_store
from tidewell.llm.packing import pack
from tidewell.llm.tokens import Pieces, encoder

TEXTS = [
    "", None, "a", "  lead and trail  ", "a  b\n\n c", "one line.\nTwo, (three)! don't we'll 'S", "foo <|endoftext|> bar<|endoftext|>", "no break x y", "x\x1cy \x1f z", "\t\tz \r\n",
    "é́ ǆ 中文 test 🙂🙂  🙂", "AAAA" * 500, "0123456789" * 30, "<|endoftext|", "Å B ΑΣ ΑΣΑ Σ İstanbul", "thé,### ñandú%%% x÷, ×,y", "word " * 3000, "the quick brown fox " * 200,
]


def docs(spark):
    rows = [(100 - i, t) for i, t in enumerate(TEXTS)] + [(3, "twice"), (3, "twice"), (None, "no name")]
    return spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, start int").repartition(3), rows


def ids_of(name, text):
    return Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids


def test_round_trip(spark):
    df, rows = docs(spark)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = sorted((r.doc_id or -1, list(r.ids), r.decoded) for r in round_trip(df).collect())
    assert got == sorted((d or -1, ids_of("byte_bpe_50k.json", t), tokenizer.decode(ids_of("byte_bpe_50k.json", t), skip_special_tokens=False)) for d, t in rows)
    assert round_trip(df.filter(F.lit(False))).count() == 0


@pytest.mark.parametrize("width", [7, 2048])
def test_packing(spark, width):
    df, rows = docs(spark)
    pieces = pack(df, width=width).collect()
    whole = {}
    for p in pieces:
        whole.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, np.frombuffer(p.ids, "<u4").tolist()))
    want = {}
    for d, t in rows:
        ids = [*ids_of("byte_bpe_50k.json", t), 1]
        want.setdefault((d, len(ids)), []).append(ids)
    for key, lists in want.items():
        pieces_of = sorted(whole[key])
        assert sorted(x for _, ids in pieces_of for x in ids) == sorted(x for ids in lists for x in ids)
        if len(lists) == 1:
            assert [x for _, ids in pieces_of for x in ids] == lists[0]
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    last = max(by_sequence)
    for s, found in by_sequence.items():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at == width or s == last and at <= width
    assert sorted(by_sequence) == list(range(last + 1))
    assert pack(df.filter(F.lit(False))).count() == 0


def test_store(spark, tmp_path):
    df, rows = docs(spark)
    path = f"file://{tmp_path}/store"
    write_store(df, path)
    got = sorted((r.start, r.doc_id or -1, r.n_tokens, zlib.crc32(r.ids)) for r in read_store(spark, path).collect())
    at, want = 0, []
    for d, t in sorted(rows, key=lambda r: r[0] or -1):
        ids = np.array([*ids_of("word_bpe_49k.json", t), 2], "<u4")
        want.append((at, d or -1, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    chunks = spark.read.parquet(f"{path}/chunks")
    assert chunks.count() == chunks.select("digest").distinct().count()
    empty = f"file://{tmp_path}/empty"
    write_store(df.filter(F.lit(False)), empty)
    assert read_store(spark, empty).count() == 0


def test_store_notices_damage(spark, tmp_path):
    df, _ = docs(spark)
    path = f"file://{tmp_path}/store"
    write_store(df, path)
    chunks = spark.read.parquet(f"{path}/chunks").withColumn("content", F.expr("concat(content, x'0000')"))
    chunks.write.parquet(f"{path}/damaged")
    (tmp_path / "store/chunks").rename(tmp_path / "store/old")
    (tmp_path / "store/damaged").rename(tmp_path / "store/chunks")
    with pytest.raises(Exception, match="digest"):
        read_store(spark, path).collect()


@pytest.mark.parametrize("lost", ["doc_id = 90", "part = (select min(part) from r)", "true"])
def test_store_notices_lost_recipes(spark, tmp_path, lost):
    df, _ = docs(spark)
    path = f"file://{tmp_path}/store"
    write_store(df, path)
    spark.read.parquet(f"{path}/recipes").createOrReplaceTempView("r")
    left = spark.sql(f"select * from r where not coalesce({lost}, false)")
    assert left.count() < spark.table("r").count()
    left.write.parquet(f"{path}/damaged")
    (tmp_path / "store/recipes").rename(tmp_path / "store/old")
    (tmp_path / "store/damaged").rename(tmp_path / "store/recipes")
    with pytest.raises(Exception, match="manifest"):
        read_store(spark, path).collect()


def test_unlike_pieces_are_learnt_once():
    calls = []

    def learn(pieces):
        calls.append(pieces)
        return [b"<" + p + b">" for p in pieces]

    texts = [b"head%d and and, and 7 %d\nand" % (k % 40, k % 5) for k in range(200)] + [b"", b" lead", b"\n", b"trail "]
    want = [b"<head%d>< and>< and><,>< and>< 7>< %d><\nand>" % (k % 40, k % 5) for k in range(200)] + [b"", b"< lead>", b"<\n>", b"<trail>< >"]
    pieces = Pieces(learn, None, 1000)
    assert pieces.encode(texts) == want
    assert len(calls) <= 2
    learnt = [p for found in calls for p in found]
    assert len(learnt) == len(set(learnt))
    assert pieces.encode(texts[::-1]) == want[::-1]
    assert sum(map(len, calls)) == len(learnt)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_odd_pieces_in_one_call(name):
    chosen = random.Random(4)
    parts = ["a", "Zo", "the", "É", "ÿ", "×", "÷", "ß", "ł", "中", "🙂", "'s", "'", ",", ".", "%#", "7", "_", " ", " ", " ", "\n", "  ", "\t", "\u00a0", "\0"]
    texts = ["".join(chosen.choices(parts, k=chosen.randrange(12))) for _ in range(3000)]
    found = encoder(public_tokenizers.path(name)).encode([t.encode() for t in texts])
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    want = [x.ids for x in whole.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == want
    if name.startswith("byte"):
        made = codec(public_tokenizers.path(name)).encode([t.encode() for t in texts])
        assert [np.frombuffer(x, "<u4").tolist() for x in made] == want
