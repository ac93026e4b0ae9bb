"""Packing by concatenate and cut.

Pass one encodes every document once and writes (partition, start within the partition, ids); the totals of the
partitions, summed up in their order, are the partitions' global offsets. Pass two cuts the one stream that this gives
into windows of `width` ids: window k holds the ids from k * width on, so nothing is sorted or shuffled. A document
that crosses a window's edge gives a boundary record on either side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import columns, slices, staged, table, texts_of
from tidewell.llm.tokens import encoder

WIDTH, END_ID = 2048, 1


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack(docs: DataFrame, vocabulary: str | None = None, width: int = WIDTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Every sequence but the last holds `width` ids. Null and empty texts are one end id. Rows that repeat, also with
    their doc_id, are packed each for itself; a null doc_id stays null. An empty table gives no rows. Columns other than
    doc_id and text are not read.
    """
    spark, path = docs.sparkSession, vocabulary or default_vocabulary()
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, at = encoder(path).encode, 0
        for batch in slices(batches):
            ids = [x + end for x in encode_all(texts_of(batch))]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            starts = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            narrow = [np.frombuffer(x, "<u4") for x in ids]
            narrow = [(b"2" + x.astype("<u2").tobytes()) if x.max() < 65536 else b"4" + x.tobytes() for x in narrow]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(starts), pa.array(sizes), pa.array(narrow, pa.binary())], names=["doc_id", "local_start", "doc_tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    encoded = columns(docs, "doc_id", "text").mapInArrow(encode, f"doc_id {kind}, local_start long, doc_tokens long, ids binary")
    encoded, _ = staged(encoded.select(F.spark_partition_id().alias("part"), "*"), "packing")
    # One row per partition of the first pass; a running sum over so few rows may stand in one task.
    totals = encoded.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = {r.part: r.at for r in totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("at")).collect()}
    shared = spark.sparkContext.broadcast(offsets)  # 16 bytes for each task of the first pass

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            parts, local, sizes = (batch.column(n).to_numpy() for n in ("part", "local_start", "doc_tokens"))
            first = local + np.array([shared.value[p] for p in parts.tolist()], np.int64)
            last = first + sizes - 1
            n = last // width - first // width + 1
            row = np.repeat(np.arange(len(n)), n)
            sequence = np.repeat(first // width, n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            low = np.maximum(first[row], sequence * width)
            high = np.minimum(last[row] + 1, (sequence + 1) * width)
            start = low - first[row]
            raw = [np.frombuffer(x, "<u2" if x[:1] == b"2" else "<u4", offset=1).astype("<u4") for x in batch.column("ids").to_pylist()]
            ids = [raw[r][s : s + k].tobytes() for r, s, k in zip(row.tolist(), start.tolist(), (high - low).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(high - low), pa.array(ids, pa.binary()), pa.array(sizes[row]), pa.array(sequence), pa.array(low - sequence * width)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return encoded.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents")))


__all__ = ["digest", "op10_packing", "pack"]
