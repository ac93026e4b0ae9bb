"""Suffix-array dedup: bytes that a long repeated string covers go, in every place.

Super-k-mers (see windows.py) cut the work to strings that may hold windows of one another, and deal those to shards
such that equal windows meet. Each shard is sorted by suffixes (see induced_sort.py): windows with the common-prefix
value `width` to a neighbour repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import discard, slices, staged, table, texts_of
from tidewell.llm.induced_sort import InducedSort, equal_neighbours
from tidewell.llm.windows import Units, keyed, merged, occurrences, one_kind, strings, with_spans

WIDTH, K = 200, 32


def repeated(pieces: list[bytes], width: int, memory: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first byte, last byte + 1) of the runs of bytes that windows cover which stand twice in the pieces."""
    raw = b"\0".join(pieces) + b"\0"
    sizes = np.array([len(p) for p in pieces])
    begin = np.cumsum(sizes + 1) - sizes - 1
    text = np.frombuffer(raw, np.uint8).astype(np.uint16) + np.uint16(2)
    text[begin + sizes] = 1
    window = np.zeros(len(raw) + 1, np.int32)
    full = sizes >= width
    np.add.at(window, begin[full], 1)
    np.add.at(window, (begin + sizes - width + 1)[full], -1)
    order = InducedSort(text, width, memory).order()
    order = order[np.cumsum(window)[:-1].astype(bool)[order]]
    same = equal_neighbours(raw, order, width)
    twice = same | np.append(same[1:], False)
    at = np.sort(order[twice])
    cover = np.zeros(len(raw) + 1, np.int32)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    inside = np.cumsum(cover) > 0
    edge = np.diff(inside.astype(np.int8), prepend=0)
    low, high = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
    piece = np.searchsorted(begin, low, side="right") - 1
    return piece, low - begin[piece], high - begin[piece]


def sort_shards(found: DataFrame, width: int, shard: int, memory: int) -> DataFrame:
    """key, start, end of the repeated bytes of the strings. A shard ends at the first minimiser beyond `shard` bytes."""

    def settle(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        piece, low, high = repeated([r[2] for r in rows], width, memory)
        key = np.array([r[0] for r in rows], np.int64)[piece]
        start = np.array([r[1] for r in rows], np.int64)[piece]
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(start + low), pa.array(start + high)], names=["key", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, size = None, [], 0
        for batch in batches:
            for minimiser, key, start, string in zip(*(batch.column(c).to_pylist() for c in ("minimiser", "key", "start", "string")), strict=True):
                if minimiser != now and size > shard:
                    yield settle(rows)
                    rows, size = [], 0
                now = minimiser
                rows.append((key, start, string))
                size += len(string)
        if rows:
            yield settle(rows)

    return found.repartition("minimiser").sortWithinPartitions("minimiser").select("minimiser", "key", "start", "string").mapInArrow(run, "key long, start long, end long")


def find_repeats(base: DataFrame, width: int = WIDTH, k: int = K, shard: int = 1 << 22, memory: int = 1 << 26) -> DataFrame:
    """key, start, end of repeated bytes, overlapping, for the texts of base (doc_id, key, text; see windows.keyed)."""
    spark, units = base.sparkSession, Units("bytes", width, k)
    found, path = staged(occurrences(base.withColumn("doc_id", F.lit(0).cast("long")), units).drop("doc_id"), "occurrences")
    one = F.min(F.struct("key", "start")).alias("place")
    kinds, kinds_path = staged(
        found.groupBy("minimiser", "digest").agg(F.count("*").alias("n"), one, F.first("windows").alias("windows"), F.max("twice").alias("twice"), F.min("check").alias("low"), F.max("check").alias("high")).select("minimiser", one_kind("low", "high").alias("digest"), "n", "windows", "twice", F.col("place.key").alias("key"), F.col("place.start").alias("start")),
        "superkmers",
    )
    whole = found.join(kinds.filter("n > 1").select("minimiser", "digest"), ["minimiser", "digest"]).select("key", F.col("start").cast("long").alias("start"), (F.col("start") + F.col("windows") + width - 1).cast("long").alias("end"))
    unlike = kinds.groupBy("minimiser").agg(F.count("*").alias("unlike"), F.max(F.col("twice") & (F.col("n") == 1)).alias("twice")).filter("unlike > 1 or twice").select("minimiser")
    wanted = kinds.join(unlike, "minimiser").select("key", "minimiser", "start", "windows")
    whole, _ = staged(whole, "spans")
    discard(spark, path)
    wanted, wanted_path = staged(wanted, "wanted")
    discard(spark, kinds_path)
    parts, _ = staged(sort_shards(strings(base, wanted, units, []), width, shard, memory), "spans")
    discard(spark, wanted_path)
    return whole.unionByName(parts).distinct()


def remaining(text: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    kept, at = [], 0
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return b"".join(kept)


def remove_repeats(docs: DataFrame, width: int = WIDTH, k: int = K, shard: int = 1 << 22, memory: int = 1 << 26) -> DataFrame:
    """doc_id, n (bytes), removed, spans (maximal removed runs), kept (binary).

    A byte goes if a string of `width` bytes that covers it also starts anywhere else in the table, the same row
    included. Null texts are empty; shorter texts lose nothing. Rows that repeat lose all of a long enough text. A null
    doc_id stays null. An empty table gives no rows. Other columns aren't read.
    """
    base = keyed(docs)

    def make(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, int, bytes]:
        out = remaining(text, starts, ends)
        return len(text), len(text) - len(out), len(starts), out

    return with_spans(base, find_repeats(base, width, k, shard, memory), ["key"], make)


def cut_repeats(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """The columns of docs, with texts that remove_repeats leaves; a character that loses a byte goes wholly. Rows of
    whose text nothing but white space is left go, rows that lose nothing stay as they are."""
    lists = find_repeats(keyed(docs), width, k).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    names = docs.columns
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    text, short = f"c{names.index('text')}", list(own.columns)
    joined = own.withColumn("key", F.xxhash64(F.coalesce(text, F.lit("")))).join(lists, "key", "left").select(*short, "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            keep, texts = [], []
            for raw, spans in zip(texts_of(batch, text), batch.column("spans").to_pylist(), strict=True):
                if spans:
                    start, end = merged(np.array([x["start"] for x in spans]), np.array([x["end"] for x in spans]))
                    raw = remaining(raw, start, end).decode("utf-8", "ignore").encode()
                keep.append(not spans or bool(raw.strip()))
                texts.append(raw)
            columns = [pa.array(texts, pa.binary()).cast(pa.string()) if c == text else batch.column(c) for c in short]
            yield pa.RecordBatch.from_arrays(columns, names=short).filter(pa.array(keep))

    made = joined.mapInArrow(run, own.schema)
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = remove_repeats(table(spark, sf_dir, "documents"))
    return made.select("doc_id", F.col("n").alias("n_bytes"), F.col("removed").alias("n_removed"), F.col("spans").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
