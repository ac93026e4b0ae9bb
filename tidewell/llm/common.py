"""What the operators of this subpackage share: staging tables, batch slicing, hashing of words."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 21
U64 = np.uint64


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = found.get() if found.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tidewell-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder for a table or store that goes, if nobody discards it before, when the driver's JVM
    ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores behind it as no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df written as Parquet to the shared folder and read again, and its path. Cuts the lineage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    tidy(spark)
    return spark.read.schema(df.schema).parquet(path), path


def tidy(spark: SparkSession) -> None:
    """Let go of shuffle files that no plan needs any more: Spark deletes them once their plans are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def tune(spark: SparkSession) -> SparkSession:
    """Arrow batches of 8 MB at most: rows here may hold texts of 100 kB and more, and a worker holds a batch or two."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    return spark


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete staging tables that no later plan reads."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows in batches whose texts hold about `limit` bytes together (one row at least): bounds a worker's memory."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < n:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null becomes empty."""
    return [x or b"" for x in batch.column(text).cast(pa.binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), elementwise."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(n, base, U64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class WordHash(dict):
    """64-bit hash of a word, the same in every process; keeps the words it has met, up to a bound, only to save time."""

    def __init__(self, bound: int = 300_000):
        super().__init__()
        import xxhash

        self.bound, self.digest = bound, xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = self.digest(word)
        return value

    def many(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that clashing further columns can't matter."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")
