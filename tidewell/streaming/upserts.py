"""Incremental runs: a stream of records into a table that holds, for each key, what its records say last.

Each micro-batch is one delta, a folder of its own, with a row for each of its keys; nothing that is there is written
again. The table is what the deltas give together, each field by its newest record that has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType


def overlaid(records: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row a key: of each field the value of its last record, by the order, that isn't null."""
    at = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    latest = [F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), at)).alias(c) for c in records.columns if c != key]
    made = records.groupBy(key).agg(*latest) if latest else records.select(key).distinct()
    return made.select(*records.columns)


def upsert_stream(records: DataFrame, key: str, folder: str, checkpoint: str, sequence: str | None = None) -> StreamingQuery:
    """Each micro-batch becomes the delta of its number; one that is run again writes the same rows to the same place.
    Records of one key in one batch follow each other by `sequence`, and, where that is equal or not given, by their
    values, so that the outcome doesn't hang on the order in which tasks see them. Read the table with `newest`."""

    def land(batch: DataFrame, number: int) -> None:
        order = ([F.col(sequence)] if sequence else []) + [F.to_json(F.struct("*"))]
        overlaid(batch, key, order).write.mode("overwrite").parquet(f"{folder}/delta={number}")

    return records.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deltas(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/delta=*")
    whole = StructType([*schema.fields]).add("delta", LongType())
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", folder).parquet(folder)


def newest(spark: SparkSession, folder: str, schema: StructType, key: str | None = None) -> DataFrame:
    """The table as the deltas give it; key: the first field, unless named. One aggregation by key."""
    key = key or schema.fieldNames()[0]
    found = deltas(spark, folder, schema)
    return overlaid(found, key, [F.col("delta")]).drop("delta")


def compact(spark: SparkSession, folder: str, schema: StructType, target: str, key: str | None = None) -> int | None:
    """Writes the table as the one delta of another folder, under the number of its last one, and returns that: a stream
    whose checkpoint goes on can write its next deltas there."""
    last = deltas(spark, folder, schema).agg(F.max("delta")).first()[0]
    if last is not None:
        newest(spark, folder, schema, key).write.mode("overwrite").parquet(f"{target}/delta={last}")
    return last
