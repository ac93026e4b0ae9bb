"""Seasonality: which months of the year a key is active in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def activity(df: DataFrame, key: str, day: str) -> DataFrame:
    """One row a key: years (sorted), total, months (12 counts). One shuffle; rows without key or day don't count."""
    month = F.month(day)
    counts = [F.count_if(month == m).alias(f"m{m}") for m in range(1, 13)]
    made = df.filter(F.col(key).isNotNull() & F.col(day).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_set(F.year(day))).alias("years"), F.count("*").alias("total"), *counts)
    return made.select(key, "years", "total", F.array(*[f"m{m}" for m in range(1, 13)]).alias("months"))


def best_window(months: Column, total: Column, longest: int = 6, percent: int = 60) -> Column:
    """struct<size, less, back>: the shortest circular window that holds `percent` of the total; of equals the one that
    holds more (-less), then the later start (-back). Null if none does. Evaluated in place over the 12 counts."""
    twice = F.concat(months, months)

    def option(i: Column) -> Column:
        size, start = F.floor(i / 12).cast("int") + 1, (i % 12 + 1).cast("int")
        covered = F.aggregate(F.slice(twice, start, size), F.lit(0).cast("long"), lambda n, x: n + x)
        return F.struct(size.alias("size"), (-covered).alias("less"), (-start).alias("back"))

    options = F.transform(F.sequence(F.lit(0), F.lit(12 * longest - 1)), option)
    return F.array_min(F.filter(options, lambda o: -o["less"] * 100 >= total * percent))


def cadence(df: DataFrame, key: str, day: str, min_years: int = 2) -> DataFrame:
    """key, years_observed, total, window_start, window_end, covered, percent, confidence, for keys seen in enough years
    that have a window."""
    known = activity(df, key, day).filter(F.size("years") >= min_years)
    # Exploding the one window evaluates it once, and leaves out the keys that have none.
    made = known.select(key, "years", "total", F.inline(F.array_compact(F.array(best_window(F.col("months"), F.col("total"))))))
    years, start, covered = F.size("years"), -F.col("back"), -F.col("less")
    return made.select(
        key, years.cast("long").alias("years_observed"), "total", start.cast("long").alias("window_start"), ((start + F.col("size") - 2) % 12 + 1).cast("long").alias("window_end"),
        covered.alias("covered"), F.floor(covered * 100 / F.col("total")).alias("percent"), F.when(years >= 4, "high").when(years >= 3, "medium").otherwise("low").alias("confidence"),
    )


def stable_months(df: DataFrame, key: str, day: str, min_years: int = 2) -> DataFrame:
    """key, month, years: months in which the key is seen in enough different years."""
    return df.groupBy(key, F.month(day).cast("long").alias("month")).agg(F.count_distinct(F.year(day)).alias("years")).filter(F.col("years") >= min_years)


def month_histogram(df: DataFrame, day: str) -> DataFrame:
    """month, n for all twelve months; a constant number of rows, made by one aggregation."""
    one = df.agg(*[F.count_if(F.month(day) == m).alias(f"m{m}") for m in range(1, 13)])
    return one.select(F.posexplode(F.array(*[f"m{m}" for m in range(1, 13)]))).select((F.col("pos") + 1).cast("long").alias("month"), F.col("col").alias("n"))


def peak_months(df: DataFrame, day: str, percent: int = 60) -> DataFrame:
    one = df.agg(*[F.count_if(F.month(day) == m).alias(f"m{m}") for m in range(1, 13)]).select(F.array(*[f"m{m}" for m in range(1, 13)]).alias("months"))
    return one.select(F.array_max("months").alias("most"), F.posexplode("months")).filter(F.col("col") * 100 >= F.col("most") * percent).select((F.col("pos") + 1).cast("long").alias("month"), F.col("col").alias("n"))


def evidence(df: DataFrame, key: str, day: str, most: int = 8) -> DataFrame:
    """key, evidence: its newest distinct days, newest first, joined."""
    days = F.transform(F.slice(F.sort_array(F.collect_set(F.to_date(day)), asc=False), 1, most), lambda d: F.date_format(d, "yyyy-MM-dd"))
    return df.groupBy(key).agg(F.array_join(days, ",").alias("evidence"))
