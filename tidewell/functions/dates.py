"""Dates in text, circular months, instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A date as year-month-day with marks or in Chinese, and one without a year.
FULL_DATE = r"((?:19|20)[0-9]{2})(?:年|[-/.])([0-9]{1,2})(?:月|[-/.])([0-9]{1,2})日?"
SHORT_DATE = r"(?<![0-9年])([0-9]{1,2})月([0-9]{1,2})日"


def in_window(month: Column, start: Column, end: Column) -> Column:
    """Whether the month lies in the circular window; end may come before start."""
    return F.when(start <= end, (month >= start) & (month <= end)).otherwise((month >= start) | (month <= end))


def dates_in(c: Column) -> Column:
    """Valid full dates of the text as ISO strings, each once, in order of appearance."""
    found = F.regexp_extract_all(c, F.lit(FULL_DATE), 0)
    parts = F.transform(found, lambda x: F.concat_ws("-", F.regexp_extract(x, FULL_DATE, 1), F.lpad(F.regexp_extract(x, FULL_DATE, 2), 2, "0"), F.lpad(F.regexp_extract(x, FULL_DATE, 3), 2, "0")))
    return F.array_distinct(F.filter(parts, lambda x: F.try_to_date(x, "yyyy-MM-dd").isNotNull()))


def clock(hour: Column, minute: Column, period: Column) -> Column:
    """HH:MM of a clock time with a period of the day (am, pm); 24:00 is allowed, null otherwise out of range."""
    h = F.when((period == "pm") & (hour < 12), hour + 12).otherwise(hour)
    fine = ((h >= 0) & (h < 24) & (minute >= 0) & (minute < 60)) | ((h == 24) & (minute == 0))
    return F.when(fine, F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":"), F.lpad(minute.cast("string"), 2, "0")))


def instant(day: Column, time: Column, is_start: Column) -> Column:
    """A day and an optional HH:MM as timestamp; 24:00 is the next day, starts default to 00:00, others to 23:59:59."""
    base = F.to_timestamp_ntz(F.date_format(day, "yyyy-MM-dd"))
    seconds = F.when(time.isNull(), F.when(is_start, 0).otherwise(86399)).otherwise(F.substring(time, 1, 2).cast("int") * 3600 + F.substring(time, 4, 2).cast("int") * 60)
    return base + F.make_dt_interval(secs=seconds)


def days_since(day: Column, today: Column, unknown: int = 99999) -> Column:
    """Days from an ISO day to today; `unknown` for what is no day."""
    return F.coalesce(F.datediff(today, F.try_to_date(day, "yyyy-MM-dd")), F.lit(unknown))


def days_until(day: Column, today: Column) -> Column:
    """Days from today to an ISO day, null for what is no day."""
    return F.datediff(F.try_to_date(day, "yyyy-MM-dd"), today)


def is_fresh(day: Column, today: Column, days: int = 90) -> Column:
    return days_since(day, today) <= days


def ago_text(days: Column) -> Column:
    """A number of days in words; empty for null and for what days_since gives for an unknown day."""
    count = lambda n, unit: F.concat(n.cast("string"), F.lit(unit))
    return (
        F.when(days.isNull() | (days >= 99999), "").when(days < 0, "未来").when(days == 0, "今天").when(days == 1, "昨天").when(days < 30, count(days, " 天前")).when(days < 365, count(F.floor(days / 30), " 个月前")).otherwise(count(F.floor(days / 365), " 年前"))
    )


def deadline_text(day: Column) -> Column:
    """An ISO day as month and day; anything else as it is, null as empty."""
    parts = r"^(\d{4})-(\d{2})-(\d{2})$"
    number = lambda i: F.regexp_extract(day, parts, i).try_cast("int").cast("string")
    return F.when(day.rlike(parts), F.concat(number(2), F.lit("月"), number(3), F.lit("日"))).otherwise(F.coalesce(day, F.lit("")))


def month_label(month: Column) -> Column:
    return F.concat(month.cast("string"), F.lit("月"))


def window_label(start: Column, end: Column) -> Column:
    return F.when(start == end, month_label(start)).otherwise(F.concat(month_label(start), F.lit("–"), month_label(end)))


def next_window(start_month: Column, today: Column, days: int = 14) -> Column:
    """struct<first, behind>: the first of the month, this year or, if that month is over, next year; and `days` later."""
    year = F.year(today) + (start_month < F.month(today)).cast("int")
    first = F.make_date(year, start_month, F.lit(1))
    return F.struct(first.alias("first"), F.date_add(first, days).alias("behind"))
