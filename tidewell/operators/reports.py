"""Facets, counts, coverage, reasons and groups for display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def facet_filter(df: DataFrame, facets: dict[str, Column | None]) -> DataFrame:
    """Only the facets that are set."""
    for condition in facets.values():
        if condition is not None:
            df = df.filter(condition)
    return df


def facet_counts(df: DataFrame, facets: dict[str, Column]) -> DataFrame:
    """facet, value, n stacked; null values count as "?". One pass: each row is exploded to its facets."""
    pairs = F.array(*[F.struct(F.lit(name).alias("facet"), F.coalesce(c.cast("string"), F.lit("?")).alias("value")) for name, c in facets.items()])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.facet", "p.value").agg(F.count("*").alias("n"))


def group_by_month(df: DataFrame, day: str, order: list[Column]) -> DataFrame:
    """month (yyyy-MM), and heading: whether the row begins a month of the sorted list. The order must be total. The
    first row of each month is found by aggregation and joined, so no month is gathered in one task."""
    dated = df.withColumn("month", F.date_format(day, "yyyy-MM")).withColumn("at__", F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    first = dated.groupBy("month").agg(F.min("at__").alias("first__"))
    return dated.join(F.broadcast(first), dated.month.eqNullSafe(first.month)).drop(first.month).withColumn("heading", F.col("at__") == F.col("first__")).drop("at__", "first__")


def coverage(df: DataFrame, ok: Column) -> DataFrame:
    """total, good, rate (four places, null if empty)."""
    made = df.agg(F.count("*").alias("total"), F.count_if(ok).alias("good"))
    return made.withColumn("rate", F.round(F.col("good") / F.nullif(F.col("total"), F.lit(0)), 4))


def primary_reason(reasons: list[tuple[str, Column]], other: str) -> Column:
    """First reason, in order, that holds."""
    out = F.lit(other)
    for name, condition in reversed(reasons):
        out = F.when(condition, name).otherwise(out)
    return out


def zero_filled(df: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """column, n for each value of the domain."""
    labels = df.sparkSession.createDataFrame([(d,) for d in domain], f"{column} string")
    return labels.join(df.groupBy(column).agg(F.count("*").alias("n")), column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def display_groups(df: DataFrame, key: Column, member: str, rank: list[Column]) -> DataFrame:
    """representative (least rank) and members of each group. Only ids travel, not the rows."""
    return df.groupBy(key.alias("key__")).agg(F.min(F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)], F.col(member))).getField(member).alias("representative"), F.count("*").alias("members")).drop("key__")
