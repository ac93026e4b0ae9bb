"""Notices as they are shown: reposts behind one of them, revisions tied to what they revise, cards of competitions with
what is current and what is past."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.functions import dates, facts, text

#: Fixed value: marks of reposting before a title.
REPOST = r"^\s*(?:【转载】|\[转载\]|转载[:：])\s*"
#: What stands in place of a deadline, and the title of a notice that isn't known.
UNSURE, NOTHING, ORIGINAL = "时间待核实，请查看原文", "暂未提取到，请查看原文", "原通知"


def grouped(notices: DataFrame) -> DataFrame:
    """notices with group_url: that of the notice that stands for it and its reposts.

    notices: url (unique), title, date, competition, edition_id, year, edition, track, phase, stage, content_hash, has_fields.
    Notices are one group if all of these and their titles agree, without marks of reposting, and their content is the same;
    where no content is known, their date. Without an edition or a date nothing proves a repost. A group is stood for by a
    notice with fields before one without, then by the earliest. Only ids travel; a group is never gathered."""
    known = F.col("year").isNotNull() | F.col("edition").isNotNull()
    proof = F.coalesce(F.concat(F.lit("body:"), F.nullif("content_hash", F.lit(""))), F.concat(F.lit("date:"), F.nullif("date", F.lit(""))), F.concat(F.lit("url:"), "url"))
    key = F.struct(
        F.coalesce(F.nullif("competition", F.lit("")), "url").alias("a"), F.when(known, F.col("edition_id")).otherwise(F.col("url")).alias("b"), F.coalesce("track", F.lit("")).alias("c"), F.coalesce("phase", F.lit("")).alias("d"),
        F.coalesce("stage", F.lit("")).alias("e"), text.title_key(F.coalesce("title", F.lit("")), REPOST).alias("f"), proof.alias("g"),
    )
    keyed = notices.withColumn("key__", F.sha2(F.to_json(key), 256))
    rank = F.struct(~F.coalesce("has_fields", F.lit(False)), F.coalesce(F.nullif("date", F.lit("")), F.lit("9999")), "url")
    first = keyed.groupBy("key__").agg(F.min_by("url", rank).alias("group_url"))
    return keyed.join(first, "key__").drop("key__")


def repost_sources(shown: DataFrame, label: str) -> DataFrame:
    """group_url, url, date, label of the members of groups of several (shown: as grouped gives them)."""
    many = shown.groupBy("group_url").agg(F.count("*").alias("n")).filter("n > 1").select("group_url")
    return shown.join(many, "group_url").select("group_url", "url", F.coalesce("date", F.lit("")).alias("date"), F.col(label).alias("label"))


def revision_links(slots: DataFrame, notices: DataFrame) -> DataFrame:
    """url, old_url, title, status: which notice revises, or may revise (needs_review), what another one told. slots: with
    changes, as editions.slots gives them; notices: url, title. Each link once."""
    told = slots.select(F.explode("changes").alias("c")).select(F.col("c.url").alias("url"), F.explode("c.old").alias("old_url"), F.col("c.status").alias("status"))
    links = told.filter("old_url <> url").distinct().join(notices.select("url"), "url", "left_semi")
    titles = notices.select(F.col("url").alias("old_url"), F.col("title").alias("title"))
    return links.join(titles, "old_url", "left").select("url", "old_url", F.coalesce("title", F.lit(ORIGINAL)).alias("title"), "status")


def shown_deadlines(slots: DataFrame) -> DataFrame:
    """url, deadline: what the deadlines that a notice tells of, or told of, come to by now."""
    own = slots.filter(F.col("kind").isin(*facts.DEADLINES))
    sure = F.filter("entries", lambda e: e["verification"] == "source_matched")
    label = F.transform(sure, lambda e: F.concat(F.coalesce(F.concat("track", F.lit("：")), F.lit("")), F.concat_ws(" ", dates.deadline_text(e["value"]), e["time"])))
    urls = F.array_distinct(F.transform(F.concat("entries", "history"), lambda e: e["url"]))
    each = own.select(F.explode(urls).alias("url"), (F.col("state") != "confirmed").alias("unsure"), F.when(F.col("state") == "confirmed", label).otherwise(F.array().cast("array<string>")).alias("labels"))
    made = each.groupBy("url").agg(F.bool_or("unsure").alias("unsure"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("labels")))).alias("labels"))  # as many as a notice tells
    return made.select("url", F.when(F.col("unsure"), UNSURE).when(F.size("labels") > 0, F.array_join("labels", "；")).otherwise(NOTHING).alias("deadline"))


def cards(shown: DataFrame, slots: DataFrame, current: DataFrame) -> DataFrame:
    """competition, shelf (current or archive), position (from 1 on its shelf), url, title, date, deadline: the notices of a
    competition's card, one of each group, newest first, then those with a deadline, then those with fields.

    shown: as grouped gives them; current: edition_id of the editions that are current."""
    own = shown.filter("competition is not null and group_url = url")
    now = current.select("edition_id").distinct().withColumn("now__", F.lit(True))
    joined = own.join(now, "edition_id", "left").join(shown_deadlines(slots), "url", "left")
    shelf: Column = F.when(F.col("now__"), "current").otherwise("archive")
    joined = joined.withColumns({"shelf": shelf, "known__": F.coalesce(~F.col("deadline").isin(UNSURE, NOTHING), F.lit(False)), "deadline": F.coalesce("deadline", F.lit(NOTHING))})
    order = Window.partitionBy("competition", "shelf").orderBy(F.desc(F.coalesce("date", F.lit(""))), F.desc("known__"), F.desc(F.coalesce("has_fields", F.lit(False))), "url")
    return joined.select("competition", "shelf", F.row_number().over(order).alias("position"), "url", "title", "date", "deadline")
