"""States over time: slots, conflicts, gaps, editions, registration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def slot_history(df: DataFrame, slot: list[str], value: str, order: list[str]) -> DataFrame:
    """previous: the slot's value before; changed: whether it differs; changes: how often it has so far."""
    w = Window.partitionBy(*slot).orderBy(*order)
    made = df.withColumn("previous", F.lag(value).over(w))
    made = made.withColumn("changed", F.coalesce(F.col("previous") != F.col(value), F.lit(False)))
    return made.withColumn("changes", F.sum(F.col("changed").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def mark_conflicts(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, n, values, conflict: whether a group has more than one value."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct(value).alias("values")).withColumn("conflict", F.col("values") > 1)


def safe_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """key, safe: the one distinct value of the key, or null."""
    return df.groupBy(key).agg(F.min(value).alias("low"), F.max(value).alias("high")).select(key, F.when(F.col("low") == F.col("high"), F.col("low")).alias("safe"))


def registration_status(start: Column, deadline: Column, now: Column) -> Column:
    return F.when(deadline.isNull() & start.isNull(), "unknown").when(start > now, "not_started").when(deadline < now, "closed").otherwise("open")


def roll_up(state: Column) -> Column:
    """State of a key from those of its parts: open over conflict over needs_review, else closed or not_started where
    all parts are."""
    has = lambda s: F.bool_or(state == s)
    return F.when(has("open"), "open").when(has("conflict"), "conflict").when(has("needs_review"), "needs_review").when(F.bool_and(state == "closed"), "closed").when(F.bool_and(state == "not_started"), "not_started").otherwise("unknown")


def current_edition(df: DataFrame, key: str, day: str) -> DataFrame:
    """Rows of each key's latest year."""
    latest = df.groupBy(key).agg(F.max(F.year(day)).alias("edition"))
    return df.join(latest, key).filter(F.year(day) == F.col("edition"))


def latest_per_key(df: DataFrame, key: str, order: list[Column], keep: list[str], extra: list[Column]) -> DataFrame:
    """One row a key: `extra` aggregates, and the columns to keep of its row with the largest order."""
    best = F.max(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *keep)).alias("best")
    made = df.groupBy(key).agg(*extra, best)
    return made.select(*[c for c in made.columns if c != "best"], *[F.col(f"best.{c}").alias(c) for c in keep])


def gap_clusters(df: DataFrame, key: str, ts: str, order: list[str], seconds: int) -> DataFrame:
    """cluster: number, from 1, of the run of rows without a gap of more than `seconds`."""
    w = Window.partitionBy(key).orderBy(ts, *order)
    gap = F.timestamp_diff("SECOND", F.lag(ts).over(w), F.col(ts)) > seconds
    return df.withColumn("begins", F.coalesce(gap, F.lit(True)).cast("long")).withColumn("cluster", F.sum("begins").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("begins")


def carry_forward(df: DataFrame, key: str, order: list[str], value: Column, out: str) -> DataFrame:
    """out: the last value so far that isn't null."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def nearest_above(df: DataFrame, key: str, order: list[str], mark: Column, value: str, out: str) -> DataFrame:
    """out: value of the latest earlier row that is marked."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.last(F.when(mark, F.col(value)), ignorenulls=True).over(w))


def lookback(df: DataFrame, line: str, mark: Column, reach: int, out: str) -> DataFrame:
    """out: the nearest marked line number up to `reach` lines before. Each marked line is copied to the lines that it
    reaches, so this is an equi-join whatever the size."""
    marks = df.filter(mark).select(F.explode(F.sequence(F.col(line) + 1, F.col(line) + reach)).alias("line__"), F.col(line).alias("mark__")).groupBy("line__").agg(F.max("mark__").alias(out))
    return df.join(marks, F.col(line) == F.col("line__"), "left").drop("line__")
