"""Tables put together again from the fragments of pages: what a PDF gives of them is text at places.

Each row has one anchor, a fragment of a column that never wraps; cells stand centred in their rows, so the fragments of a
column are cut into as many runs as there are rows, nearest to the anchors (layout.monotone_partition). Cells that reach
over several rows are their marks' labels, dealt out the same way. All of a page's work is on arrays of its lines.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.operators import layout


@dataclass(frozen=True)
class Shape:
    """edges: where columns begin (x), the first one excepted; columns: their names, from left to right. anchor: column and
    pattern of a row's anchor. mark: column, pattern and (word, label) pairs of cells over several rows, in order of
    precedence. section: pattern (first group) of a line that titles a section. noise: pattern of lines that are no part of
    the table. digits: columns of which only fragments of digits count. gap: marks closer than this are one."""

    edges: list[float]
    columns: list[str]
    anchor: tuple[str, str]
    mark: tuple[str, str, list[tuple[str, str]]] | None = None
    section: str | None = None
    noise: str | None = None
    digits: list[str] = field(default_factory=list)
    gap: float = 20.0


UNKNOWN = "?"


def assemble(fragments: DataFrame, shape: Shape, carry: bool = False, tolerance: float = 2.0) -> DataFrame:
    """doc, page, row (from 1), y, section, category and a column for each of the shape's: one row for each anchor.

    fragments: doc, page, y (upwards), x, text; those without a place are left out. Pages without an anchor give no rows. A
    column with fewer lines than rows fills the first rows; a page with fewer rows than marks has no categories. A row has
    the section that stands nearest above it on its page, or, with carry, in the document."""
    at = ["doc", "page"]
    placed = layout.columns_by_x(layout.in_lines(fragments.filter("x is not null and text is not null"), at, "y", "x", "text", tolerance), "x", shape.edges)
    cell = F.element_at(F.array(*map(F.lit, shape.columns)), F.col("cell") + 1)
    part = F.struct("x", "text")
    lines = placed.withColumn("column", cell).groupBy(*at, "line", "y").agg(F.sort_array(F.collect_list(part)).alias("parts"), F.sort_array(F.collect_list(F.struct("column", "x", "text"))).alias("cells"))
    whole = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    lines = lines.withColumn("text", whole)
    of = lambda name: F.filter("cells", lambda c: c["column"] == name)
    lines = lines.withColumn("anchor", F.exists(of(shape.anchor[0]), lambda c: c["text"].rlike(f"^(?:{shape.anchor[1]})$")))
    if shape.noise:
        noise = F.regexp_replace("text", r"\s", "").rlike(shape.noise)
        lines = lines.withColumn("noise", noise).withColumn("anchor", F.col("anchor") & ~F.col("noise"))
    else:
        lines = lines.withColumn("noise", F.lit(False))
    order = Window.partitionBy("doc").orderBy("page", "line") if carry else Window.partitionBy(*at).orderBy("line")
    title = F.nullif(F.regexp_extract("text", shape.section, 1), F.lit("")) if shape.section else F.lit(None).cast("string")
    lines = lines.withColumn("section", F.last(title, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    mark = F.regexp_replace(F.array_join(F.transform(F.filter(of(shape.mark[0]), lambda c: ~c["text"].rlike(r"^\d+$")), lambda c: c["text"]), ""), r"\s", "") if shape.mark else F.lit("")
    line = F.struct("line", "y", "anchor", "section", F.when(F.lit(bool(shape.mark)) & mark.rlike(f"^(?:{shape.mark[1]})$") if shape.mark else F.lit(False), mark).alias("mark"), "cells")
    pages = lines.filter(~F.col("noise")).groupBy(*at).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    pages = pages.withColumn("anchors", F.filter("lines", lambda x: x["anchor"])).filter(F.size("anchors") > 0).withColumn("centres", F.transform("anchors", lambda a: a["y"]))

    def own(name: str) -> Column:
        """The lines of a column: y, text, n (fragments)."""

        def one(x: Column) -> Column:
            kept = F.filter(x["cells"], lambda c: (c["column"] == name) & (c["text"].rlike(r"^\s*\d+\s*$") if name in shape.digits else F.lit(True)))
            return F.struct(x["y"].alias("y"), F.array_join(F.transform(kept, lambda c: c["text"]), "").alias("text"), F.size(kept).alias("n"))

        return F.filter(F.transform("lines", one), lambda c: c["n"] > 0)

    for name in shape.columns:
        pages = pages.withColumn(f"{name}__", own(name))
        pages = pages.withColumn(f"{name}__at", layout.partition_to(F.transform(f"{name}__", lambda c: c["y"]), F.col("centres")))
    pages = with_marks(pages, shape) if shape.mark else pages.withColumn("labels", F.array().cast("array<string>")).withColumn("labels__at", F.array().cast("array<bigint>"))
    label = F.when(F.size("labels") == 1, F.col("labels")[0])
    category = lambda i: label.when((F.size("labels") > 1) & (F.size("centres") >= F.size("labels")), F.get("labels", F.get("labels__at", i).cast("int")))
    # Rows and what stands in them go apart, so that nothing of a page is copied for each of its rows.
    kind = "array<struct<i:bigint,y:double,section:string,category:string,column:string,n:int,text:string>>"
    none = F.lit(None)
    anchors = F.transform("anchors", lambda a, i: F.struct(i, a["y"], a["section"], F.coalesce(category(i), F.lit(UNKNOWN)), none, none, none)).cast(kind)

    def within(name: str) -> Column:
        zipped = F.arrays_zip(F.col(f"{name}__").alias("c"), F.col(f"{name}__at").alias("g"))
        return F.transform(zipped, lambda z, n: F.struct(z["g"], none, none, none, F.lit(name), n, z["c"]["text"])).cast(kind)

    rows = pages.select(*at, F.inline(F.concat(anchors, *[within(name) for name in shape.columns]))).groupBy(*at, "i")

    def text(name: str) -> Column:
        parts = F.sort_array(F.collect_list(F.when(F.col("column") == name, F.struct("n", "text"))))
        return F.regexp_replace(F.array_join(F.transform(parts, lambda p: p["text"]), ""), r"\s+", "").alias(name)

    made = rows.agg(F.max("y").alias("y"), F.max("section").alias("section"), F.max("category").alias("category"), *[text(name) for name in shape.columns])
    return made.select(*at, (F.col("i") + 1).cast("int").alias("row"), "y", "section", "category", *shape.columns)


def with_marks(pages: DataFrame, shape: Shape) -> DataFrame:
    """labels of a page's marks from top to bottom, and for each row the number of its mark (labels__at)."""
    kind = "array<struct<last:double,total:double,n:int,text:string>>"

    def merge(done: Column, m: Column) -> Column:
        """Marks are few on a page."""
        last = F.try_element_at(done, F.lit(-1))
        near = F.coalesce(F.abs(last["last"] - m["y"]) <= shape.gap, F.lit(False))
        joined = F.struct(m["y"].alias("last"), (last["total"] + m["y"]).alias("total"), (last["n"] + 1).alias("n"), F.concat(last["text"], m["mark"]).alias("text"))
        fresh = F.struct(m["y"].alias("last"), m["y"].alias("total"), F.lit(1).alias("n"), m["mark"].alias("text"))
        return F.when(near, F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(fresh))).cast(kind)

    found = pages.withColumn("marks", F.aggregate(F.filter("lines", lambda x: x["mark"].isNotNull()), F.array().cast(kind), merge))
    label = lambda m: F.coalesce(*[F.when(F.contains(m["text"], F.lit(word)), F.lit(name)) for word, name in shape.mark[2]], F.lit(UNKNOWN))
    ordered = F.array_sort("marks", lambda a, b: F.when(a["total"] / a["n"] > b["total"] / b["n"], -1).when(a["total"] / a["n"] < b["total"] / b["n"], 1).otherwise(0))
    found = found.withColumn("marks", ordered).withColumn("labels", F.transform("marks", label))
    return found.withColumn("labels__at", layout.partition_to(F.col("centres"), F.transform("marks", lambda m: m["total"] / m["n"])))
