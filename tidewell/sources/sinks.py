"""Sinks: JSON envelopes, CSV with a byte-order mark, Markdown tables, script bundles, calendars.

These are documents for people and pages, one file each. Tasks write their rows as the lines of parts; the driver only
strings the parts together, by streams of bytes in the file system, whatever their number. Rows stand in the order of the
table that is given, so sort it if that matters.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def replaced(spark: SparkSession, path: str, fill) -> None:  # noqa: ANN001
    """One file, that fill(stream) writes beside its place and that is then moved over it in one step, so that a reader sees
    the old one or the new one whole, never none."""
    jvm = spark._jvm
    target, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".part")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(beside, True)
    fill(out)
    out.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration()).rename(files.makeQualified(beside), files.makeQualified(target), over)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    replaced(spark, path, lambda out: out.write(bytearray(text.encode())))


class Parts:
    """The rows of a text column as lines of part files beside a document, in order, each with `end` and a line feed behind
    it. `between` goes before each row but the first. Rows aren't read in Python."""

    def __init__(self, df: DataFrame, path: str, end: str = "", between: str = ""):
        self.spark, self.folder, self.skip = df.sparkSession, f"{path}.{uuid.uuid4().hex}", len(between.encode())
        line = F.concat(F.lit(between), F.col(df.columns[0]), F.lit(end))
        df.select(line.alias("value")).write.text(self.folder)
        self.where = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self.files = self.where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def count(self) -> int:
        """Of lines: of rows, if they hold no line feeds."""
        return self.spark.read.text(self.folder).count()

    def copy(self, out) -> None:  # noqa: ANN001
        """Appends the parts to the stream, without the marks between lines, and drops them."""
        first = True
        jvm = self.spark._jvm
        for status in sorted(self.files.listStatus(self.where), key=lambda f: f.getPath().getName()):
            if status.getPath().getName().startswith("part-") and status.getLen():
                stream = jvm.java.io.BufferedInputStream(self.files.open(status.getPath()))
                if first:
                    stream.skip(self.skip)
                    first = False
                jvm.org.apache.commons.io.IOUtils.copyLarge(stream, out)
                stream.close()
        self.files.delete(self.where, True)


def document(df: DataFrame, path: str, head: str, tail: str, end: str = "", between: str = "") -> None:
    """head, the rows of df's one column, tail as one file."""
    parts = Parts(df, path, end, between)

    def fill(out) -> None:  # noqa: ANN001
        out.write(bytearray(head.encode()))
        parts.copy(out)
        out.write(bytearray(tail.encode()))

    replaced(df.sparkSession, path, fill)


def as_json(value: Column, spark: SparkSession) -> str:
    return spark.range(1).select(F.to_json(value).alias("v")).first().v


def envelope(df: DataFrame, path: str, source: str, version: int = 1) -> None:
    """{source, schema_version, count, items}."""
    spark = df.sparkSession
    parts = Parts(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("v")), path, between=",")
    head = as_json(F.struct(F.lit(source).alias("source"), F.lit(version).alias("schema_version"), F.lit(parts.count()).alias("count")), spark)

    def fill(out) -> None:  # noqa: ANN001
        out.write(bytearray((head[:-1] + ',"items":[').encode()))
        parts.copy(out)
        out.write(bytearray(b"]}\n"))

    replaced(spark, path, fill)


def csv_document(df: DataFrame, path: str) -> None:
    """With a byte-order mark and a header, columns in the table's order; quotes where needed."""
    quoted = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")).rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in df.columns]
    document(df.select(F.concat_ws(",", *quoted).alias("v")), path, "\ufeff" + ",".join(df.columns) + "\r\n", "", end="\r")


def markdown(df: DataFrame, path: str, title: str) -> None:
    cells = [F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in df.columns]
    head = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), ""]
    document(df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("v")), path, "\n".join(head), "")


def script_bundle(tables: dict[str, DataFrame], path: str, name: str = "SITE_DATA") -> None:
    """window.<name> = {table: [rows]}; for a page."""
    parts = {table: Parts(df.select(F.to_json(F.struct("*")).alias("v")), path, between=",") for table, df in tables.items()}

    def fill(out) -> None:  # noqa: ANN001
        before = f"window.{name} = {{"
        for table, rows in parts.items():
            out.write(bytearray(f'{before}"{table}":['.encode()))
            rows.copy(out)
            before = "],"
        out.write(bytearray((("]" if parts else before) + "};\n").encode()))

    replaced(next(iter(tables.values())).sparkSession, path, fill)


def calendar_file(df: DataFrame, event: str, path: str, product: str, name: str) -> None:
    """The events of a column in order, lines folded by bytes, as one calendar."""
    from tidewell.operators.layout import fold, fold_lines

    head = ["BEGIN:VCALENDAR", "VERSION:2.0", f"PRODID:{product}", f"X-WR-CALNAME:{name}"]
    lines = df.select(F.explode(F.split(event, "\r\n")).alias("line")).select(fold_lines("line").alias("v"))
    document(lines, path, "\r\n".join(fold(x) for x in head) + "\r\n", "END:VCALENDAR\r\n", end="\r")


def by_state(df: DataFrame, folder: str, states: dict[str, str]) -> None:
    """One Parquet table for each state, by its condition; conditions may overlap."""
    for state, condition in states.items():
        df.filter(condition).write.mode("overwrite").parquet(f"{folder}/{state}")
