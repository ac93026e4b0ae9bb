"""Facts with evidence from dated notices: typed dates, contacts, links to a catalogue, editions, repost groups.

Every fact keeps the exact text that it was read from (`raw`, at `start` to `end` in code points) and flags; a fact with
flags needs review.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import facts, text
from tidewell.operators import editions, history, reports

#: What makes a title of each state, deny before allow.
EXCLUDED = r"获奖|公示|结果|名单|喜报|表彰"
TARGET = r"报名|参赛|选拔|竞赛|大赛|挑战赛|通知"
RETRY = ["timeout", "connection reset", "502", "503", "504", "temporarily"]


def events(notices: DataFrame, key: str, body: str, published: str) -> DataFrame:
    """One row a date: key, kind, value, time, end_value, raw, start, end, begin, before, after, flags, verification,
    superseded, revises.

    Deadlines of one kind with several values are in conflict; where one of them stands behind words of change, those
    with another value are superseded. revises: the text before says that something moves to this date. Null bodies have
    none.
    """
    base = notices.select(key, F.coalesce(body, F.lit("")).alias("text__"), F.col(published).cast("string").alias("day__"))
    # The dates of one notice are few and stay in its row, so nothing is shuffled.
    found = facts.date_events(base, "text__", "day__", "all__").filter(F.size("all__") > 0)

    # What each kind of deadline is told to be, and what it is said to be moved to.
    values = lambda kind: F.array_distinct(F.transform(F.filter("all__", lambda o: (o["kind"] == kind) & o["value"].isNotNull()), lambda o: F.concat_ws(" ", o["value"], o["time"])))
    days = lambda kind: F.array_distinct(F.transform(F.filter("all__", lambda o: (o["kind"] == kind) & o["value"].isNotNull() & F.array_contains(o["flags"], "postponed") & o["before"].rlike(facts.CHANGED)), lambda o: o["value"]))
    told = F.struct(*[F.struct(F.size(values(kind)).alias("n"), F.slice(days(kind), 1, 2).alias("to")).alias(kind) for kind in facts.DEADLINES])
    found = found.select("*", F.inline(F.array(F.struct(told.alias("told__")))))

    def judged(e: Column) -> Column:
        here = F.coalesce(*[F.when(e["kind"] == kind, F.col(f"told__.{kind}")) for kind in facts.DEADLINES])
        conflict = F.coalesce(e["value"].isNotNull() & (here["n"] > 1), F.lit(False))
        moved = F.coalesce(F.exists(here["to"], lambda v: v != e["value"]), F.lit(False))
        flags = F.when(conflict, F.array_append(e["flags"], F.lit("conflict"))).otherwise(e["flags"])
        return F.struct(e.alias("e"), flags.alias("flags"), (conflict & moved).alias("superseded"))

    made = found.select(key, F.inline(F.transform("all__", judged)))
    verification = F.when(F.size("flags") > 0, "needs_review").otherwise("source_matched")
    parts = ("kind", "value", "time", "end_value", "raw", "start", "end", "begin", "before", "after")
    return made.select(key, *[F.col(f"e.{p}").alias(p) for p in parts], "flags", verification.alias("verification"), "superseded", F.col("e.before").rlike(facts.REVISED_TO).alias("revises"))


def safe_deadlines(found: DataFrame, key: str) -> DataFrame:
    """key, safe: the deadline of a notice, if those without flags agree on one day and time."""
    deadlines = found.filter(F.col("kind").isin(*facts.DEADLINES))
    fine = (F.size("flags") == 0) & ~F.col("superseded") & F.col("value").isNotNull()
    one = F.collect_set(F.when(fine, F.struct("value", "time")))
    return deadlines.groupBy(key).agg(one.alias("of")).select(key, F.when(F.size("of") == 1, F.col("of")[0]["value"]).alias("safe"))


def contacts(notices: DataFrame, key: str, body: str) -> DataFrame:
    """key, emails, phones, qq: each value once, in order of appearance."""
    c = F.coalesce(body, F.lit(""))
    qq = F.regexp_extract_all(c, F.lit(r"(?i)qq[群号]?[:：]?\s*([1-9][0-9]{4,10})"), 1)
    return notices.select(key, F.array_distinct(text.emails(c)).alias("emails"), F.array_distinct(text.phones(c)).alias("phones"), F.array_distinct(qq).alias("qq"))


def state(title: Column, status: Column) -> Column:
    """target, excluded or review, from the title and how the page was read."""
    return F.when(F.coalesce(status, F.lit("")) != "success", "review").when(text.allow_deny(title, TARGET, EXCLUDED), "target").when(title.rlike(EXCLUDED), "excluded").otherwise("review")


def identity(title: Column) -> Column:
    """struct<year, edition, phase>: what edition of a competition a title names; null members where it names none or
    several."""
    whole = editions.identity(title)
    return F.struct(whole["year"].alias("year"), whole["edition"].alias("edition"), whole["phase"].alias("phase"))


def bridge_editions(notices: DataFrame, by: str, key: str) -> DataFrame:
    """Fills a missing year or edition number from the one anchor of the same competition that has both; several
    anchors leave it open. Columns: by, key, year, edition."""
    anchors = notices.filter("year is not null and edition is not null").select(by, F.col("year").alias("a_year"), F.col("edition").alias("a_edition")).distinct()
    near = notices.join(anchors, by, "left").filter("a_year is null or year <=> a_year or edition <=> a_edition or (year is null and edition is null)")
    half = (F.col("year").isNull() != F.col("edition").isNull()) & ((F.col("year") == F.col("a_year")) | (F.col("edition") == F.col("a_edition")))
    made = near.groupBy(by, key, "year", "edition").agg(F.count_if(half).alias("fits"), F.max(F.when(half, F.col("a_year"))).alias("fill_year"), F.max(F.when(half, F.col("a_edition"))).alias("fill_edition"))
    filled = made.select(by, key, F.coalesce("year", F.when(F.col("fits") == 1, F.col("fill_year"))).alias("year"), F.coalesce("edition", F.when(F.col("fits") == 1, F.col("fill_edition"))).alias("edition"))
    return notices.select(by, key, F.col("year").alias("y"), F.col("edition").alias("e")).join(filled, [by, key], "left").select(by, key, F.coalesce("year", "y").alias("year"), F.coalesce("edition", "e").alias("edition"))


def repost_groups(notices: DataFrame, title: str, day: str, key: str) -> DataFrame:
    """representative, members: reposts have one title apart from marks of reposting; the earliest stands for them."""
    return reports.display_groups(notices.withColumn("rank_day", F.coalesce(F.nullif(F.col(day), F.lit("")), F.lit("9999"))), text.title_key(F.col(title)), key, [F.col("rank_day")])


def check_evidence(found: DataFrame, notices: DataFrame, key: str, body: str) -> DataFrame:
    """Facts whose raw text isn't what stands at their offsets; none, if all is well."""
    return found.join(notices.select(key, F.col(body).alias("body")), key).filter(F.substring(F.col("body"), F.col("start") + 1, F.col("end") - F.col("start")) != F.col("raw")).drop("body")


def registration(found: DataFrame, key: str, now: Column) -> DataFrame:
    """key, status at `now`, rolled up over the dates of registration that aren't superseded."""
    live = found.filter(~F.col("superseded") & F.col("kind").isin("registration_start", *facts.DEADLINES))
    start = F.max(F.when(F.col("kind") == "registration_start", F.col("value")))
    slots = live.groupBy(key).agg(start.alias("s"), F.max(F.when(F.col("kind").isin(*facts.DEADLINES), F.concat_ws(" ", "value", F.coalesce("time", F.lit("23:59"))))).alias("d"), F.bool_or(F.array_contains("flags", "conflict")).alias("conflict"))
    return slots.select(key, F.when(F.col("conflict"), "conflict").otherwise(history.registration_status(F.col("s"), F.col("d"), now)).alias("status"))


def retry(status: Column, error: Column, attempts: Column, most: int = 2) -> Column:
    """Whether a failed fetch is tried again: only errors that may pass, and only so often."""
    return (status == "failed") & text.contains_any(F.lower(error), RETRY) & (attempts <= most)
