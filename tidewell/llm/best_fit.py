"""Vector best-fit packing of documents into sequences.

A sequence has capacities of tokens, of documents and of attention cost (the sum of squared lengths), and a piece takes
of each what its length says. So pieces differ by length alone, and how many there are of each length - at most `width`
numbers, however many rows - is all that best-fit decreasing needs: `fit` places all pieces of a length at once into bins
of equal residuals, as placing them one by one would. What it returns are runs: the pieces of a length from one rank to
another go to bins from some number on. Ranks within a length are counted in each task and shifted by the counts of the
tasks before it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import columns, slices, staged, table, texts_of
from tidewell.llm.tokens import encoder

WIDTH, END_ID = 2048, 0
#: In what is left of tokens, documents and attention; the tokens decide, the others among bins that they leave alike.
WEIGHTS = (1.0, 1e-6, 1e-6)


@dataclass(frozen=True)
class Limits:
    """Of one sequence. Without a limit of documents or attention of its own, a sequence may hold what its tokens allow.

    `select`: "norm" takes the bin of the least weighted norm of what is left once the piece is in; "dot" that of the
    largest weighted product of the piece and what is left before."""

    tokens: int = WIDTH
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = WEIGHTS
    select: str = "norm"

    def capacity(self) -> np.ndarray:
        whole = (self.tokens, self.tokens if self.documents is None else self.documents, self.tokens**2 if self.attention is None else self.attention)
        if self.tokens < 1 or whole[1] < 1 or whole[2] < 1:
            raise ValueError("a sequence holds at least one token, one document and a cost of one")
        if self.select not in ("norm", "dot"):
            raise ValueError("select is norm or dot")
        return np.array(whole, np.int64)

    def longest(self) -> int:
        """The longest piece that a sequence can hold."""
        return min(self.tokens, int(np.sqrt(float(self.capacity()[2]))))


#: Of a run: length of the pieces, rank of the first, their number, number of the first bin, pieces in each bin, place of the first in its bin.
RUN = [(name, np.int64) for name in ("length", "rank", "pieces", "bin", "each", "offset")]


def fit(counts: Mapping[int, int], limits: Limits) -> np.ndarray:
    """Runs (by length and rank) that place counts[length] pieces of each length: longest first, each into the bin that
    `limits.select` names among those with room in every capacity, the earliest opened of equals, or else into a new one."""
    whole = limits.capacity()
    weights = np.array(limits.weights)
    left, first, many = np.empty((0, 3), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    runs, opened = [], 0
    lengths = sorted((n for n, c in counts.items() if c), reverse=True)
    for length in lengths:
        if length > limits.longest():
            raise ValueError(f"no sequence holds a piece of {length} tokens")
        need = np.array([length, 1, length * length], np.int64)
        rank, todo = 0, counts[length]
        while todo:
            room = np.flatnonzero((left >= need).all(axis=1))
            if len(room):
                rest = left[room] - need if limits.select == "norm" else left[room] * need
                score = rest / whole / (whole if limits.select == "dot" else 1)
                score = -(score * weights).sum(axis=1) if limits.select == "dot" else (score * score * weights).sum(axis=1)
                best = room[np.lexsort((first[room], score))[0]]
                have, at, bins = left[best], int(first[best]), int(many[best])
            else:
                have, at, bins, best = whole, opened, todo, None
            # By norm, a bin that has got a piece is the best for the next one too, and a new bin is while nothing else has
            # room; by product, the next bin of its like is better.
            each = int((have // need).min()) if limits.select == "norm" or best is None else 1
            full = min(bins, todo // each)
            part = todo - full * each if full < bins else 0
            states = [(have - each * need, at, full), (have - part * need, at + full, 1 if part else 0)]
            for pieces, start, per in ((full * each, at, each), (part, at + full, part)):
                if pieces:
                    runs.append((length, rank, pieces, start, per, whole[0] - have[0]))
                    rank, todo = rank + pieces, todo - pieces
            used = full + bool(part)
            if best is None:
                opened += used
            else:
                states.append((have, at + used, bins - used))
                left, first, many = (np.delete(x, best, axis=0) for x in (left, first, many))
            states = [s for s in states if s[2] and s[0].min() > 0]
            if states:
                left = np.concatenate([left, [s[0] for s in states]])
                first, many = np.append(first, [s[1] for s in states]), np.append(many, [s[2] for s in states])
        # Bins without room for the least length are closed.
        open_ = left[:, 0] >= lengths[-1]
        left, first, many = left[open_], first[open_], many[open_]
    return np.array(sorted(runs), dtype=RUN)


def place(runs: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of the pieces of these lengths and ranks."""
    starts = np.unique(runs["length"])
    low, high = np.searchsorted(runs["length"], starts), np.searchsorted(runs["length"], starts, side="right")
    at = np.empty(len(length), np.int64)
    for n in np.unique(length).tolist():
        i, rows = int(np.searchsorted(starts, n)), length == n
        at[rows] = low[i] + np.searchsorted(runs["rank"][low[i] : high[i]], rank[rows], side="right") - 1
    run = runs[at]
    nth = rank - run["rank"]
    return run["bin"] + nth // run["each"], run["offset"] + nth % run["each"] * length


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack(docs: DataFrame, vocabulary: str | None = None, limits: Limits | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), sequence_id, offset.

    Null and empty texts are one end id. Only a document longer than a sequence can hold is cut, into pieces of that
    length and a last one that may be shorter; full pieces are sequences by themselves (by a negative number). Rows that
    repeat, also with their doc_id, are packed each for itself; a null doc_id stays null. An empty table gives no rows.
    Columns other than doc_id and text are not read. Ids come from the tokenizers library, but for words of Latin letters,
    which a faster engine encodes by the file's merge ranks (see tokens).
    """
    limits = limits or Limits()
    path, longest = vocabulary or default_vocabulary(), limits.longest()
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, seen, number = encoder(path).encode, np.zeros(longest + 1, np.int64), 0
        for batch in slices(batches):
            ids = [x + end for x in encode_all(texts_of(batch))]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            n = -(-sizes // longest)
            row = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * longest
            length = np.minimum(sizes[row] - start, longest)
            cut = [ids[r] if k == s else ids[r][4 * a : 4 * (a + k)] for r, a, k, s in zip(row.tolist(), start.tolist(), length.tolist(), sizes[row].tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            lengths, at, many = np.unique(length[order], return_index=True, return_counts=True)
            rank = np.empty(len(row), np.int64)
            rank[order] = np.arange(len(row)) - np.repeat(at, many) + np.repeat(seen[lengths], many)
            seen[lengths] += many
            made = [batch.column("doc_id").take(pa.array(row)), *map(pa.array, (piece.astype(np.int32), start, length, rank, number + np.arange(len(row)))), pa.array(cut, pa.binary())]
            number += len(row)
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "piece", "start", "length", "rank", "number", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    encoded = columns(docs, "doc_id", "text").mapInArrow(encode, f"doc_id {kind}, piece int, start long, length long, rank long, number long, ids binary")
    encoded, _ = staged(encoded.select(F.spark_partition_id().alias("part"), "*"), "pieces")
    full, rest = encoded.filter(F.col("length") == limits.tokens), encoded.filter(F.col("length") < limits.tokens)
    # A row for each task and length: the counts of the tasks before it, and for the driver one number a length.
    counts = rest.groupBy("part", "length").agg(F.count("*").alias("pieces"))
    runs = fit({r.length: r.pieces for r in counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()}, limits)
    shared = docs.sparkSession.sparkContext.broadcast(runs)  # 48 bytes a run; their number depends on the lengths there are, not on rows

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found, offset = place(shared.value, batch.column("length").to_numpy(), batch.column("rank").to_numpy())
                yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("number"), pa.array(found), pa.array(offset)], names=["part", "number", "sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("part", "length", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("shift"))
    ranked = rest.select("part", "number", "length", "rank").join(shifts, ["part", "length"]).select("part", "number", "length", (F.col("rank") + F.col("shift")).alias("rank"))
    placed = ranked.mapInArrow(look_up, "part int, number long, sequence_id long, offset long")
    made = ("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")
    alone = full.withColumns({"sequence_id": -1 - (F.shiftleft(F.col("part").cast("long"), 40) + F.col("number")), "offset": F.lit(0).cast("long")})
    return alone.select(*made).unionByName(rest.join(placed, ["part", "number"]).select(*made))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pack(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


__all__ = ["Limits", "fit", "op12_best_fit_packing", "pack", "place"]
