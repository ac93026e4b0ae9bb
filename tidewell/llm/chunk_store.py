"""Token ids in a content-addressed store.

A rolling hash over the ids cuts each document's stream where the hash says so, whatever stands before; so documents
that share a passage share chunks. A store is a folder with three tables: `chunks` has each unlike chunk once, under the
digest of its bytes; `recipes` has for each document, in ascending doc_id, the digests of its chunks and the root of the
Merkle tree over them; `manifest` has for each part of the recipes its number of documents and ids and the Merkle root
over its documents. Reading checks every chunk, document and part against its digest.

Bytes of a chunk: "2" or "4", then the ids as little-endian unsigned integers of so many bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import SLICE_BYTES, U64, columns, discard, mix64, scratch, slices, staged, table, texts_of
from tidewell.llm.tokens import encoder

END_ID = 2
#: Ids a chunk: least, mean beyond that, most. Ids that the rolling hash looks back.
LEAST, MEAN, MOST, REACH = 64, 256, 4096, 16


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digest(raw: bytes) -> bytes:
    return blake2b(raw, digest_size=16).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """Root of the binary tree over the leaves; an odd node goes up as it is."""
    while len(leaves) > 1:
        up = [digest(a + b) for a, b in zip(leaves[::2], leaves[1::2], strict=False)]
        leaves = up + leaves[len(leaves) - len(leaves) % 2 :]
    return leaves[0] if leaves else digest(b"")


def rolling(ids: np.ndarray) -> np.ndarray:
    """Whether the rolling hash calls for a cut behind each id. The hash at an id weighs the ids before it by powers of
    two, so it rolls; it is grown by doubling the reach."""
    grown, size = mix64(ids.astype(U64) + U64(0x5851F42D4C957F2D)), 1
    while size < REACH:
        longer = grown.copy()
        longer[size:] += grown[:-size] << U64(size)
        grown, size = longer, size * 2
    return (grown >> U64(40)) % U64(MEAN) == 0


def cuts(marks: list[int], n: int) -> list[int]:
    """Ends of the chunks of a document of n ids, from the ends that the hash calls for. As none is within LEAST ids of
    the document's start, it doesn't matter that the hash there looks back into another document."""
    out, at = [], 0
    for mark in marks:
        while mark - at > MOST:
            at += MOST
            out.append(at)
        if mark - at >= LEAST and n - mark >= LEAST:
            at = mark
            out.append(at)
    while n - at > MOST:
        at += MOST
        out.append(at)
    return [*out, n]


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[:1] == b"2" else "<u4", offset=1)


def parts_of(recipes: DataFrame) -> DataFrame:
    """part, documents, tokens and the Merkle root over the documents, by local_start, of each part of the recipes."""

    def root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(k, 1) for c in ("part", "documents", "tokens")] + [pa.array([merkle(batch.column("roots")[k].as_py())], pa.binary())], names=["part", "documents", "tokens", "root"])

    listed = recipes.groupBy("part").agg(F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens"), F.transform(F.sort_array(F.collect_list(F.struct("local_start", "root"))), lambda x: x["root"]).alias("roots"))
    return listed.mapInArrow(root, "part int, documents long, tokens long, root binary")


def write_store(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Encode the texts of docs (doc_id, text), each with the end id behind it, into a store at the path.

    Null and empty texts are one end id. Rows that repeat, also with their doc_id, are stored each for itself; a null
    doc_id comes first. An empty table makes an empty store. Columns other than doc_id and text are not read.
    """
    spark, file = docs.sparkSession, vocabulary or default_vocabulary()
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A document (digest null; content: digests and sizes of its chunks) or a chunk that this task has not met."""
        encode_all = encoder(file).encode
        width = 2 if max(encoder(file).size, end_id + 1) <= 65536 else 4  # by vocabulary, so that equal ids are equal bytes
        met: set[bytes] = set()
        for batch in slices(batches, limit=4 * SLICE_BYTES):  # the more at once, the more often a word meets its like
            rows, sizes, recipes, roots, names, contents = [], [], [], [], [], []
            raws = [raw + end for raw in encode_all(texts_of(batch))]
            ids = np.frombuffer(b"".join(raws), "<u4")
            flat, head = ids.astype(f"<u{width}").tobytes(), str(width).encode()
            marks, first = (np.flatnonzero(rolling(ids)) + 1).tolist(), 0
            at_mark = 0
            for row, raw in enumerate(raws):
                n = len(raw) // 4
                own = []
                while at_mark < len(marks) and marks[at_mark] <= first + n:
                    own.append(marks[at_mark] - first)
                    at_mark += 1
                leaves, at, recipe = [], first, []
                for stop in cuts(own, n):
                    chunk = head + flat[at * width : (first + stop) * width]
                    name = digest(chunk)
                    leaves.append(name)
                    recipe.append(name + (first + stop - at).to_bytes(4, "little"))
                    if name not in met:
                        if len(met) > 200_000:
                            met.clear()
                        met.add(name)
                        names.append(name)
                        contents.append(chunk)
                    at = first + stop
                first += n
                rows.append(row)
                sizes.append(n)
                recipes.append(b"".join(recipe))
                roots.append(merkle(leaves))
            ids_of = batch.column("doc_id").take(pa.array(rows + [None] * len(names), pa.int32()))
            none = [None] * len(names)
            yield pa.RecordBatch.from_arrays(
                [ids_of, pa.array(sizes + none, pa.int64()), pa.array(roots + none, pa.binary()), pa.array([None] * len(rows) + names, pa.binary()), pa.array(recipes + contents, pa.binary())],
                names=["doc_id", "n_tokens", "root", "digest", "content"],
            )

    made, made_path = staged(columns(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text").mapInArrow(encode, "doc_id long, n_tokens long, root binary, digest binary, content binary"), "encoded")
    chunks = made.filter("digest is not null").groupBy("digest").agg(F.first("content").alias("content"))
    chunks.write.option("compression", "zstd").parquet(f"{path}/chunks")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            sizes = batch.column("n_tokens").to_numpy()
            start = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(start)], names=[*batch.schema.names, "local_start"])

    parts = max(1, made.rdd.getNumPartitions())
    recipes = made.filter("digest is null").select("doc_id", "n_tokens", "root", "content").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "root")
    recipes = recipes.mapInArrow(place, "doc_id long, n_tokens long, root binary, content binary, local_start long")
    # local_start is unique in a part, as each document has an id at least.
    recipes.select(F.spark_partition_id().alias("part"), "local_start", "doc_id", "n_tokens", "root", F.col("content").alias("recipe")).write.option("compression", "zstd").parquet(f"{path}/recipes")
    parts_of(spark.read.parquet(f"{path}/recipes")).write.parquet(f"{path}/manifest")
    discard(spark, made_path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit) of each document.

    A chunk, document or part that isn't what its digest says stops the query, parts before anything is returned.
    """
    recipes = spark.read.parquet(f"{path}/recipes")
    manifest = spark.read.parquet(f"{path}/manifest").orderBy("part").collect()  # one row a part
    if sorted(map(tuple, parts_of(recipes).collect())) != sorted(map(tuple, manifest)):  # as many rows
        raise ValueError("a part of the recipes isn't what the manifest says")
    starts, at = {}, 0
    for r in manifest:
        starts[r.part] = at
        at += r.tokens
    shared = spark.sparkContext.broadcast(starts)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("recipe").to_pylist()
            row = np.repeat(np.arange(len(raw)), [len(x) // 20 for x in raw])
            at = np.concatenate([np.arange(len(x) // 20) for x in raw]) if raw else np.empty(0, np.int64)
            names = [raw[r][20 * k : 20 * k + 16] for r, k in zip(row.tolist(), at.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("part").take(pa.array(row)), batch.column("local_start").take(pa.array(row)), pa.array(at.astype(np.int32)), pa.array(names, pa.binary())], names=["part", "local_start", "place", "digest"])

    wanted = recipes.select("part", "local_start", "recipe").mapInArrow(split, "part int, local_start long, place int, digest binary")
    found = wanted.join(spark.read.parquet(f"{path}/chunks"), "digest", "left")
    whole = found.groupBy("part", "local_start").agg(F.sort_array(F.collect_list(F.struct("place", "digest", "content"))).alias("chunks"))
    joined = whole.join(recipes.drop("recipe"), ["part", "local_start"]).select("part", "local_start", "doc_id", "n_tokens", "root", "chunks.digest", "chunks.content")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = [shared.value[p] + s for p, s in zip(batch.column("part").to_pylist(), batch.column("local_start").to_pylist(), strict=True)]
            ids = []
            for names, contents, root, n in zip(*(batch.column(c).to_pylist() for c in ("digest", "content", "root", "n_tokens")), strict=True):
                if any(x is None or digest(x) != name for name, x in zip(names, contents, strict=True)):
                    raise ValueError("a chunk is missing or isn't what its digest says")
                parts = [unpacked(x) for x in contents]
                if merkle(names) != root or sum(map(len, parts)) != n:
                    raise ValueError("a document isn't what its recipe says")
                ids.append(np.concatenate(parts).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(start, pa.int64()), batch.column("n_tokens"), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    return joined.mapInArrow(rebuild, "doc_id long, start long, n_tokens long, ids binary")


def op4_chunk_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "store")
    write_store(table(spark, sf_dir, "documents"), path)
    return read_store(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
