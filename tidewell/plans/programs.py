"""Composite programs: from notices and a catalogue to the tables of a site and its calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import dates, text
from tidewell.operators import cadence, calendar, crawl, decisions, dictionary, extraction, layout, linking, merging, notices
from tidewell.operators.results import Store
from tidewell.sources import lists


def linked_notices(found: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """Notices (url, title, date, ..) with the competition that their titles name, longest keyword first."""
    return linking.link_longest(found, "title", names, "competition")


def weekly(old: DataFrame, new: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """Newly listed notices laid over those known, by URL, and linked again."""
    return linked_notices(merging.upsert(old, new, "url"), names)


def site_competitions(catalogue: DataFrame, found: DataFrame, today: Column) -> DataFrame:
    """The catalogue (name, ..) with notice counts, the latest notice, whether it is recent, and its activity window."""
    dated = found.filter("competition is not null and coalesce(date, '') <> ''").withColumn("day", F.try_to_date("date", "yyyy-MM-dd")).filter("day is not null")
    latest = dated.groupBy("competition").agg(F.count("*").alias("notices"), F.max_by(F.struct("url", "title", "date"), F.struct("day", "url")).alias("latest"))
    windows = cadence.cadence(dated, "competition", "day")
    joined = catalogue.join(latest, catalogue.name == latest.competition, "left").drop("competition")
    joined = joined.join(windows, joined.name == windows.competition, "left").drop("competition")
    return joined.withColumn("notices", F.coalesce("notices", F.lit(0))).withColumn("recent", F.coalesce(F.datediff(today, F.try_to_date("latest.date", "yyyy-MM-dd")) <= 90, F.lit(False)))


def calendar_events(competitions: DataFrame, year: int) -> DataFrame:
    """name, event of the competitions that have a window."""
    start = F.concat(F.lit(str(year)), F.lpad(F.col("window_start").cast("string"), 2, "0"), F.lit("01"))
    months = F.concat(F.col("window_start").cast("string"), F.lit("-"), F.col("window_end").cast("string"))
    return competitions.filter("window_start is not null").select("name", calendar.event(calendar.stable_uid(F.col("name")), start, F.concat(F.col("name"), F.lit(", "), months)).alias("event"))


def search(found: DataFrame, query: str) -> DataFrame:
    """Notices whose title, competition or source match, best first."""
    score = F.greatest(*[text.match_score(F.coalesce(c, F.lit("")), F.lit(query)) for c in ("title", "competition", "source")])
    return found.withColumn("score", score).filter("score > 0").orderBy(F.desc("score"), F.desc("date"), "url")


def facts(found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dates, safe deadlines and contacts of notices (url, body, date)."""
    events = notices.events(found, "url", "body", "date")
    return events, notices.safe_deadlines(events, "url"), notices.contacts(found, "url", "body")


#: Fixed value: the relevance from which a competition is in the core calendar.
CORE = 4


def calendars(windows: DataFrame, master: DataFrame, today: Column, stamp: Column, product: str, name: str, least: int = CORE) -> DataFrame:
    """calendar (all, core), text: whole calendars of the competitions that have a window, folded by bytes.

    windows: competition, window_start (month), window_end; master: name, number, score - an event is known by its number
    in the catalogue where it has one, else by its name. stamp: as RFC 5545 writes a moment. The core has those of at least
    so much relevance. Competitions are as many as the catalogue has; a calendar is one text."""
    known = master.select(F.col("name").alias("competition"), "number", F.coalesce("score", F.lit(0)).alias("score"))
    joined = windows.filter("window_start is not null").join(known, "competition", "left").withColumn("days", dates.next_window(F.col("window_start"), today))
    label = F.concat(F.col("competition"), F.lit(" "), dates.month_label(F.col("window_start")), F.when(F.col("window_end") != F.col("window_start"), F.concat(F.lit("-"), dates.month_label(F.col("window_end")))).otherwise(F.lit("")))
    more = [F.concat(F.lit("DTSTAMP:"), stamp), F.concat(F.lit("DTEND;VALUE=DATE:"), F.date_format("days.behind", "yyyyMMdd"))]
    event = calendar.event(calendar.stable_uid(F.col("competition"), F.col("number")), F.date_format("days.first", "yyyyMMdd"), label, *more)
    rows = joined.select("competition", event.alias("event"), F.explode(F.when(F.coalesce(F.col("score") >= least, F.lit(False)), F.array(F.lit("all"), F.lit("core"))).otherwise(F.array(F.lit("all")))).alias("calendar"))
    made = rows.groupBy("calendar").agg(F.transform(F.sort_array(F.collect_list(F.struct("competition", "event"))), lambda x: x["event"]).alias("events"))
    whole = calendar.calendar(F.col("events"), product, name)
    return made.select("calendar", whole.alias("text")).select("calendar", folded("text").alias("text"))


def folded(column: str) -> Column:
    """The text with each of its lines folded."""

    @F.pandas_udf("string")
    def run(texts):  # noqa: ANN001, ANN202
        return texts.map(lambda t: None if t is None else "\r\n".join(layout.fold(line) for line in t.split("\r\n")))

    return run(F.col(column))


def deadline_map(events: DataFrame, docs: DataFrame) -> DataFrame:
    """url, safe: the deadline of each notice, from evidence that still holds: a date counts only if its words stand in the
    body (docs: url, body) where they were read. events: as notices.events gives them, by url, from an earlier run."""
    there = events.join(docs.select("url", "body"), "url").filter(F.substring("body", F.col("start") + 1, F.col("end") - F.col("start")) == F.col("raw")).drop("body")
    return notices.safe_deadlines(there, "url")


def listing_run(known: DataFrame, pages: DataFrame, sources: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(notices, status) after a run over stored list pages: what the sources (source, url, pattern, keywords, max_pages,
    seeds) list is laid over what is known (url, title, date, source), by URL, and linked to the longest of the names (name,
    target, rank); status: as lists.crawled gives it."""
    rows, status = lists.crawled(pages, sources)
    new = rows.groupBy("url").agg(F.max(F.struct("date", "title", "source")).alias("r")).select("url", "r.title", F.nullif("r.date", F.lit("")).alias("date"), "r.source")
    whole = merging.upsert(known.select("url", "title", "date", "source"), new, "url")
    plain = whole.withColumn("plain__", text.title_match_key(F.coalesce("title", F.lit(""))))
    found = names.select(text.title_match_key(F.col("name")).alias("name"), "target", "rank")
    return dictionary.link_longest(plain, "url", "plain__", found, "competition").drop("plain__"), status


def article_queue(found: DataFrame, history: DataFrame, most: int = 3) -> DataFrame:
    """url, title, state, attempts, error, wait: the articles that searches found (url, title), each once, with how far
    they are: success, failed, or pending with the seconds to wait before the next attempt (history: url, at, status,
    error)."""
    one = found.filter("coalesce(url, '') <> ''").groupBy("url").agg(F.min("title").alias("title"))
    tried = crawl.attempts(history).select("url", "status", "error", "attempts")
    joined = one.join(crawl.queue_state(one, history, most), "url").join(tried, "url", "left").withColumn("attempts", F.coalesce("attempts", F.lit(0)))
    wait = F.when(F.col("state") == "pending", F.when(F.col("attempts") == 0, F.lit(0.0)).otherwise(crawl.next_try(F.col("status"), F.col("error"), F.col("attempts"), most - 1)))
    return joined.select("url", "title", "state", "attempts", F.when(F.col("state") != "success", F.col("error")).alias("error"), wait.alias("wait"))


FACTS = "array<struct<field:string,item:string,value:string,raw:string,type:string,at:string,start:int,end:int,method:string,flags:array<string>,verification:string,track:string>>"


def field_run(store: Store, docs: DataFrame, version: str, names: DataFrame, classes: tuple[str, ...], model: DataFrame | None = None, config: str = "") -> tuple[int, DataFrame]:
    """(number of notices worked on, notices with state, reason, types, .. and facts): fields by rules, of those notices only
    whose title, body, version or configuration changed since the store's last run; what a model claims is laid beside them
    (model: rows as extraction.with_model takes them); then all are classified by their titles.

    docs: url, title, body, status; store: of kind FACTS. The facts of a notice are as many as it states."""
    keyed = docs.withColumns({"key": F.col("url"), "content": F.sha2(F.to_json(F.struct("title", "body")), 256)})

    def compute(todo: DataFrame) -> DataFrame:
        found = extraction.extract(todo.select("url", "title", "body"))
        if model is not None:
            found = extraction.with_model(found, model.join(todo.select("url"), "url", "left_semi"), todo)
        each = found.groupBy("url").agg(F.sort_array(F.collect_list(F.struct(*[c for c in extraction.COLUMNS if c != "url"]))).alias("facts"))
        made = todo.select("url").join(each, "url", "left")
        return made.select(F.col("url").alias("key"), F.coalesce("facts", F.array()).cast(FACTS).alias("result"), F.lit(None).cast("string").alias("error"))

    worked = store.refresh(keyed, compute, version, config)
    current = store.current(keyed, version, config).withColumnRenamed("state", "facts_state").withColumnRenamed("result", "facts").drop("run", "key", "content")
    return worked, decisions.classified(current, names, classes)
