"""Upserts, priority merges and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows by key: a new row's fields overlay the old one's where they aren't null; the rest stays."""
    rest = [c for c in old.columns if c != key]
    extra = [c for c in new.columns if c != key and c not in rest]
    fresh = new.select(F.col(key), *[F.col(c).alias(f"{c}__new") for c in new.columns if c != key])
    joined = old.join(fresh, key, "full_outer")
    over = [F.coalesce(F.col(f"{c}__new"), F.col(c)).alias(c) if f"{c}__new" in fresh.columns else F.col(c) for c in rest]
    return joined.select(key, *over, *[F.col(f"{c}__new").alias(c) for c in extra])


def insert_if_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.unionByName(new.join(old.select(*keys).distinct(), keys, "left_anti"))


def first_by(df: DataFrame, by: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each group: map-side aggregation instead of a window, so a large group isn't gathered."""
    names = df.columns
    least = F.min(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.struct(*names).alias("row"))).alias("least")
    return df.groupBy(*[b.alias(f"g{i}") for i, b in enumerate(by)]).agg(least).select(*[F.col(f"least.row.{c}").alias(c) for c in names])


def disambiguate(df: DataFrame, name: str, suffix: Column, order: list[Column]) -> DataFrame:
    """The second and later rows of a name get the suffix in brackets. A name so made counts as seen: a later row that
    has it from the start gets its own suffix, too. Ascending order; it must be total."""
    turn = F.row_number().over(Window.partitionBy(name).orderBy(*order))
    long_name = F.concat(F.col(name), F.lit(" ("), suffix, F.lit(")"))
    at = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    marked = df.withColumn("at__", at).withColumn("long__", long_name).withColumn("again__", turn > 1)
    made = marked.filter("again__").groupBy(F.col("long__").alias("made__")).agg(F.min("at__").alias("made_at__"))
    joined = marked.join(made, F.col(name) == F.col("made__"), "left")
    again = F.col("again__") | F.coalesce(F.col("made_at__") < F.col("at__"), F.lit(False))
    return joined.withColumn(name, F.when(again, F.col("long__")).otherwise(F.col(name))).select(*df.columns)


def priority_union(parts: list[DataFrame], key: Column, order: list[Column]) -> DataFrame:
    """One row a key, from the first part that has it."""
    tagged = [p.withColumn("priority", F.lit(i)) for i, p in enumerate(parts)]
    out = tagged[0]
    for p in tagged[1:]:
        out = out.unionByName(p)
    return first_by(out, [key], [F.col("priority"), *order])


def override(df: DataFrame, corrections: DataFrame, key: str) -> DataFrame:
    """Columns of the corrections, where not null, take the place of those of df."""
    fixed = corrections.select(key, *[F.col(c).alias(f"{c}__fix") for c in corrections.columns if c != key])
    joined = df.join(fixed, key, "left")
    return joined.select(*[F.coalesce(F.col(f"{c}__fix"), F.col(c)).alias(c) if f"{c}__fix" in fixed.columns else F.col(c) for c in df.columns])
