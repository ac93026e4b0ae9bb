"""Substring dedup over words by super-k-mer partitioning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import U64, discard, mix64, staged, table
from tidewell.llm.windows import Units, keyed, occurrences, one_kind, strings, with_spans

WIDTH, K = 50, 6


def earlier_windows(units: Units, group: list[tuple[int, int, bytes]], memory: int = 1 << 26) -> list[tuple[int, int, int]]:
    """(digest, start, end) of the runs of windows of each string (digest, first document, string) of one minimiser
    that a string of an earlier document has too. Windows are sorted as strings of word numbers, in parts of `memory`
    bytes that their hashes pick."""
    numbers: dict[bytes, int] = {}
    cut = [string.split() for _, _, string in group]
    words = np.array([numbers.setdefault(w, len(numbers)) for x in cut for w in x], np.int32)
    sizes = np.array([len(x) for x in cut])
    windows = sizes - units.width + 1
    owner = np.repeat(np.arange(len(group)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = (np.cumsum(sizes) - sizes)[owner] + offset
    first = np.array([x[1] for x in group])[owner]
    value = mix64(words.astype(U64))
    mark = np.zeros(len(words) - units.width + 1, U64)
    for j in range(units.width):
        mark = mark * U64(0xD1342543DE82EF95) + value[j : j + len(mark)]
    parts = -(-len(at) * units.width * 4 // memory)
    part = (mark[at] >> U64(33)).astype(np.int64) % parts
    hit = np.zeros(len(at), bool)
    for p in range(parts):
        some = np.flatnonzero(part == p)
        if not len(some):
            continue
        rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(words, units.width)[at[some]])
        _, same = np.unique(rows.view(f"V{units.width * 4}").ravel(), return_inverse=True)
        least = np.full(same.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, same.ravel(), first[some])
        hit[some] = least[same.ravel()] < first[some]
    hit_owner, hit_offset = owner[hit], offset[hit]
    if not len(hit_owner):
        return []
    begin = np.concatenate([[True], (hit_owner[1:] != hit_owner[:-1]) | (hit_offset[1:] != hit_offset[:-1] + 1)])
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], len(hit_owner)) - 1
    return [(group[hit_owner[i]][0], int(hit_offset[i]), int(hit_offset[j]) + units.width) for i, j in zip(starts, ends, strict=True)]


def compare(found: DataFrame, units: Units, memory: int) -> DataFrame:
    """minimiser, digest, low, high: tokens of a string that earlier documents cover."""

    def settle(minimiser: int, group: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        rows = earlier_windows(units, group, memory)
        digest, low, high = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array([minimiser] * len(rows), pa.int64()), pa.array(digest, pa.int64()), pa.array(low, pa.int32()), pa.array(high, pa.int32())], names=["minimiser", "digest", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []
        for batch in batches:
            for minimiser, digest, first, string in zip(*(batch.column(c).to_pylist() for c in ("minimiser", "digest", "first", "string")), strict=True):
                if minimiser != now:
                    if len(group) > 1:
                        yield settle(now, group)
                    now, group = minimiser, []
                group.append((digest, first, string))
        if len(group) > 1:
            yield settle(now, group)

    return found.repartition("minimiser").sortWithinPartitions("minimiser").select("minimiser", "digest", "first", "string").mapInArrow(run, "minimiser long, digest long, low int, high int")


def remove_repeats(docs: DataFrame, width: int = WIDTH, k: int = K, memory: int = 1 << 26) -> DataFrame:
    """doc_id, n (words), removed, spans (maximal removed runs), kept (binary: the kept words joined by one space).

    A word goes if a window of `width` words that covers it also starts in a row with a smaller doc_id. Null texts are
    empty; rows without as many words lose nothing. Rows with equal doc_ids don't take from each other; rows with a
    null doc_id neither take nor give. An empty table gives no rows. Other columns aren't read.
    """
    units, base = Units("words", width, k), keyed(docs)
    found, path = staged(occurrences(base.filter("doc_id is not null"), units).drop("twice"), "occurrences")
    place = F.min(F.struct("doc_id", "key", "start")).alias("place")
    kinds, kinds_path = staged(found.groupBy("minimiser", "digest").agg(F.count("*").alias("n"), place, F.first("windows").alias("windows"), F.min("check").alias("low"), F.max("check").alias("high")).select("minimiser", one_kind("low", "high").alias("digest"), "n", "windows", F.col("place.doc_id").alias("first"), F.col("place.key").alias("key"), F.col("place.start").alias("start")), "superkmers")
    unlike = kinds.groupBy("minimiser").agg(F.count("*").alias("unlike")).filter("unlike > 1").select("minimiser")
    # What a string's later documents have of it goes wholly.
    whole = found.join(kinds.filter("n > 1").select("minimiser", "digest", "first"), ["minimiser", "digest"]).filter("doc_id > first").select("doc_id", "key", "start", (F.col("start") + F.col("windows") + width - 1).alias("end"))
    # What its first document has of it goes as far as other strings of earlier documents have the windows.
    wanted = kinds.join(unlike, "minimiser").select("key", "minimiser", "start", "windows", "digest", "first")
    wanted, wanted_path = staged(wanted, "wanted")
    parts, parts_path = staged(compare(strings(base, wanted, units, ["digest", "first"]), units, memory), "parts")
    discard(docs.sparkSession, wanted_path)
    own = found.join(kinds.select("minimiser", "digest", "first"), ["minimiser", "digest"]).filter("doc_id = first").select("minimiser", "digest", "doc_id", "key", "start")
    partly = parts.join(own, ["minimiser", "digest"]).select("doc_id", "key", (F.col("start") + F.col("low")).alias("start"), (F.col("start") + F.col("high")).alias("end"))
    whole, _ = staged(whole, "spans")
    partly, _ = staged(partly, "spans")
    spans = whole.unionByName(partly)
    discard(docs.sparkSession, path, kinds_path, parts_path)

    def make(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, int, bytes]:
        words = text.split()
        kept, at = [], 0
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            kept += words[at:a]
            at = b
        kept += words[at:]
        return len(words), len(words) - len(kept), len(starts), b" ".join(kept)

    return with_spans(base, spans, ["doc_id", "key"], make)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = remove_repeats(table(spark, sf_dir, "documents"))
    return made.select("doc_id", F.col("n").alias("n_words"), F.col("removed").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
