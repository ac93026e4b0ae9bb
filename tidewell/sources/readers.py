"""Sources: JSON envelopes, CSV with a byte-order mark, ordered lines, URL lists, files by content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType
from pyspark.sql.window import Window


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where))


def envelope(spark: SparkSession, path: str, items: StructType, field: str = "items") -> DataFrame:
    """Rows of an envelope {.., items: [..]}; a missing file is an empty table. Fields that a row lacks are null."""
    if not exists(spark, path):
        return spark.createDataFrame([], items)
    whole = spark.read.schema(StructType().add(field, ArrayType(items))).json(path, multiLine=True)
    return whole.selectExpr(f"inline({field})")


def csv_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns of a CSV file with a header, trimmed; a byte-order mark is skipped by the reader."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"').select(*[F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in columns])


def whole_number(c: Column) -> Column:
    """Digits as int, anything else null."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """line_no (from 0), line: trimmed, in the file's order."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split("value", r"\r?\n"))).select(F.col("pos").alias("line_no"), F.trim("col").alias("line"))


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """URLs of a list, without blank and # lines, each once, in order. Any other line stops the query."""
    found = lines(spark, path).filter("line <> '' and not startswith(line, '#')")
    checked = found.withColumn("line", F.when(F.col("line").rlike(r"^https?://\S+$"), F.col("line")).otherwise(F.raise_error(F.concat(F.lit("not a URL: "), F.col("line")))))
    return checked.groupBy(F.col("line").alias("url")).agg(F.min("line_no").alias("line_no")).orderBy("line_no")


def blobs(spark: SparkSession, path: str) -> DataFrame:
    """path, size, sha256, kind of files, by their first bytes."""
    head = F.hex(F.substring("content", 1, 8))
    text = F.lower(F.decode(F.substring("content", 1, 200), "ISO-8859-1"))
    kind = (
        F.when(head.startswith("25504446"), "pdf").when(head.startswith("504B0304"), "docx").when(head.startswith("D0CF11E0A1B11AE1"), "doc")
        .when(head.startswith("89504E47") | head.startswith("FFD8FF") | head.startswith("47494638"), "image")
        .when(text.contains("<html") | text.contains("<!doctype"), "html").otherwise("unsupported")
    )
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), kind.alias("kind"))


def assets(records: DataFrame, key: str, attachments: str, images: str) -> DataFrame:
    """key, url, kind, id: attachments, then images, each URL once a record. Arrays of URLs."""
    both = F.concat(F.transform(F.coalesce(attachments, F.array().cast("array<string>")), lambda u: F.struct(u.alias("url"), F.lit("attachment").alias("kind"))), F.transform(F.coalesce(images, F.array().cast("array<string>")), lambda u: F.struct(u.alias("url"), F.lit("image").alias("kind"))))
    found = records.select(key, F.posexplode(both)).select(key, "pos", "col.url", "col.kind")
    first = F.row_number().over(Window.partitionBy(key, "url").orderBy("pos"))
    return found.withColumn("turn", first).filter("turn = 1").select(key, "url", "kind", F.sha2(F.concat_ws("\n", key, "url"), 256).alias("id"))


def api_pages(pages: DataFrame, body: str, item: str, keep: str) -> DataFrame:
    """Items of stored API answers {success, data: [..]} whose success isn't false. item: schema of one; keep: a
    condition on it."""
    parsed = pages.withColumn("answer", F.from_json(body, f"success boolean, data array<{item}>"))
    return parsed.filter("coalesce(answer.success, true)").selectExpr("*", "inline(answer.data)").drop("answer", body).filter(keep)
