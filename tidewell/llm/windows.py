"""Super-k-mers: runs of consecutive windows with one minimiser, and which of their windows stand elsewhere too.

A text is a sequence of tokens (bytes or words), a window `width` tokens in a row. A window's minimiser is the least hash
of the `k`-token strings in it; equal windows have equal minimisers, so they meet in one bucket. A run of windows with
one minimiser is one string of tokens, a super-k-mer, and first only its digest travels, with a check value that stops
the query if unlike strings share a digest: a string that is alone under
its minimiser holds no window of another, and equal strings hold equal windows throughout. Only unequal strings under
one minimiser have to be compared themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import U64, WordHash, mix64, powers, slices, texts_of

BASE = 0xD1342543DE82EF95
INVERSE = pow(BASE, -1, 1 << 64)
#: Low bits of a k-mer's hash that give way to its position, to tell leftmost from rightmost.
PLACE = 12


@dataclass(frozen=True)
class Units:
    """What a token is. kind: "bytes" or "words"."""

    kind: str
    width: int
    k: int

    def cut(self, text: bytes) -> bytes | list[bytes]:
        return text if self.kind == "bytes" else text.split()

    def join(self, cut: bytes | list[bytes], start: int, end: int) -> bytes:
        return cut[start:end] if self.kind == "bytes" else b" ".join(cut[start:end])


class Hasher:
    def __init__(self, units: Units):
        self.units, self.word = units, WordHash()
        self.byte = mix64(np.arange(256, dtype=U64) + U64(0x632BE59BD9B4E019))
        self.power = self.inverse = np.empty(0, U64)

    def of(self, cut: bytes | list[bytes]) -> np.ndarray:
        return self.byte[np.frombuffer(cut, np.uint8)] if self.units.kind == "bytes" else self.word.many(cut)

    def runs(self, tokens: np.ndarray) -> tuple[np.ndarray, ...]:
        """(minimiser, digest, check, start, windows, twice) of each super-k-mer. check: a second digest that tells unlike
        strings with one digest. twice: its minimiser stands in it twice, so that it may hold a window twice."""
        width, k = self.units.width, self.units.k
        n = len(tokens) - width + 1
        if n <= 0:
            none = np.empty(0, np.int64)
            return none, none, none, none, none, none.astype(bool)
        # k-mer hashes by doubling: of 2j tokens from those of j.
        grown, size, done, have = tokens, 1, None, 0
        while size <= k:
            if k & size:
                done = grown if done is None else done[: len(grown) - have] + grown[have:][: len(done) - size] * U64(pow(BASE, have, 1 << 64)) if have else grown
                have += size
            if size * 2 <= k:
                grown = grown[: len(grown) - size] + grown[size:] * U64(pow(BASE, size, 1 << 64))
            size *= 2
        hashed = done * U64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> U64(32)
        hashed *= U64(0xBF58476D1CE4E5B9)
        place = np.arange(len(hashed), dtype=U64) & U64((1 << PLACE) - 1)
        hashed &= ~U64((1 << PLACE) - 1)
        span = width - k + 1
        left = least(hashed | place, span)
        right = least(hashed | (U64((1 << PLACE) - 1) - place), span)
        value = left >> U64(PLACE)
        starts = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        windows = np.diff(np.append(starts, n))
        low = left & U64((1 << PLACE) - 1)
        unlike = low != U64((1 << PLACE) - 1) - (right & U64((1 << PLACE) - 1))
        unlike[1:] |= (low[1:] != low[:-1]) & (value[1:] == value[:-1])
        # Position bits of a run longer than they can tell apart.
        twice = np.add.reduceat(unlike.astype(np.int64), starts) > 0
        if len(self.power) < len(tokens):
            self.power, self.inverse = powers(BASE, len(tokens) * 2), powers(INVERSE, len(tokens) * 2)
        scale, back, ends = self.power[: len(tokens)], self.inverse[starts], starts + windows + width - 1

        def summed(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate([np.zeros(1, U64), np.cumsum(values * scale, dtype=U64)])
            return mix64((sums[ends] - sums[starts]) * back + windows.astype(U64))

        digest, check = summed(tokens), summed(tokens * tokens + (tokens >> U64(32))) >> U64(33)
        return value[starts].view(np.int64), digest.view(np.int64), check.view(np.int64), starts, windows, twice


def least(x: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each `span` values in a row, by doubling."""
    size = 1
    while size * 2 <= span:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    rest = span - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


OCCURRENCES = "doc_id long, key long, minimiser long, digest long, check int, start int, windows int, twice boolean"


def occurrences(docs: DataFrame, units: Units) -> DataFrame:
    """One row per super-k-mer of docs (doc_id long, key long, text string)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(units)
        for batch in slices(batches):
            columns: list[list[np.ndarray]] = [[] for _ in range(7)]
            for row, text in enumerate(texts_of(batch)):
                if len(text) < units.width:
                    continue
                found = hasher.runs(hasher.of(units.cut(text)))
                for into, x in zip(columns, (np.full(len(found[0]), row), *found), strict=True):
                    into.append(x)
            if not columns[0]:
                continue
            row, minimiser, digest, check, start, windows, twice = (np.concatenate(x) for x in columns)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("key").take(at), pa.array(minimiser), pa.array(digest), pa.array(check.astype(np.int32)), pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(twice)],
                names=["doc_id", "key", "minimiser", "digest", "check", "start", "windows", "twice"],
            )

    return docs.mapInArrow(run, OCCURRENCES)


def one_kind(low: str, high: str, digest: str = "digest") -> Column:
    """The digest of a group, if the checks of its members agree; else the query stops."""
    return F.when(F.col(low) == F.col(high), F.col(digest)).otherwise(F.raise_error(F.lit(f"two unlike strings have one 64-bit {digest}")))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and a key of the text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), F.coalesce("text", F.lit("")).alias("text"))


def strings(docs: DataFrame, wanted: DataFrame, units: Units, carry: list[str]) -> DataFrame:
    """wanted (key, minimiser, start, windows, and what is to be carried) with the strings of tokens. Of texts that
    repeat, one is read."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("minimiser", "start", "windows", *carry)).alias("runs"))
    kinds = {f.name: f.dataType.simpleString() for f in wanted.schema}
    names = ["minimiser", "start", "windows", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 19):
            texts, runs = texts_of(batch), batch.column("runs")
            flat = runs.flatten()
            of = np.repeat(np.arange(len(texts)), runs.value_lengths().to_numpy())
            start, windows = flat.field("start").to_pylist(), flat.field("windows").to_pylist()
            made, last, cut = [], -1, b""
            for row, a, n in zip(of.tolist(), start, windows, strict=True):
                if row != last:
                    last, cut = row, units.cut(texts[row])
                made.append(units.join(cut, a, a + n + units.width - 1))
            at = pa.array(of)
            yield pa.RecordBatch.from_arrays([batch.column("key").take(at), *(flat.field(n) for n in names), pa.array(made, pa.binary())], names=["key", *names, "string"])

    schema = "key long, " + ", ".join(f"{n} {kinds[n]}" for n in names) + ", string binary"
    checked = docs.withColumn("check", F.xxhash64(F.lit(units.width), "text"))
    one = checked.groupBy("key").agg(F.first("text").alias("text"), F.min("check").alias("low"), F.max("check").alias("high"))
    one = one.select(one_kind("low", "high", "key").alias("key"), "text")
    return one.join(lists, "key").select("key", "text", "runs").mapInArrow(run, schema)


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans by start, those that touch or overlap made one."""
    if len(start) < 2:
        return start, end
    reach = np.maximum.accumulate(end)
    first = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    return start[first], reach[np.append(first[1:], len(end)) - 1]


def with_spans(docs: DataFrame, spans: DataFrame, by: list[str], make: Callable[[bytes, np.ndarray, np.ndarray], tuple]) -> DataFrame:
    """doc_id of each row of docs and make(text, starts, ends) of the merged spans (by.., start, end) that it has."""
    lists = spans.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    joined = docs.join(lists, by, "left").select("doc_id", "text", "spans")
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text, found in zip(texts_of(batch), batch.column("spans"), strict=True):
                flat = found.values
                start, end = (flat.field(i).to_numpy() for i in (0, 1)) if flat is not None and len(flat) else (np.empty(0, np.int64),) * 2
                rows.append(make(text, *merged(start, end)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True))], names=["doc_id", "n", "removed", "spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, n long, removed long, spans long, kept binary")
