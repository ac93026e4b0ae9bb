"""What a reader of the site selects and sees: facets, orders, counts and listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.functions import dates, text
from tidewell.operators import reports


def searched(query: str | None, *parts: Column) -> Column | None:
    """Whether the parts together hold the query; no condition for an empty one."""
    return text.match_score(F.concat_ws(" ", *parts), F.lit(query)) > 0 if query else None


def filter_competitions(df: DataFrame, today: Column, unknown: str, *, is_open: bool = False, least: int | None = None, category: str | None = None, in_catalogue: bool | None = None, recent: bool = False, query: str | None = None) -> DataFrame:
    """Competitions (name, alias, organizer, reason, dept, domain, contact, number, score, category, is_recruiting,
    latest_date) by the facets that are set; category "__unknown" means those that have none yet."""
    named = F.col("category") == (unknown if category == "__unknown" else category) if category else None
    return reports.facet_filter(df, {
        "open": F.col("is_recruiting") if is_open else None, "least": F.col("score") >= least if least else None, "category": named,
        "catalogue": F.col("number").isNotNull() == in_catalogue if in_catalogue is not None else None, "recent": dates.is_fresh(F.col("latest_date"), today) if recent else None,
        "query": searched(query, *[F.col(c) for c in ("name", "alias", "organizer", "reason", "dept", "domain", "contact")], F.col("number").cast("string")),
    })


def filter_notices(df: DataFrame, today: Column, *, hidden: tuple[str, ...] = (), group: str | None = None, scope: str | None = None, site: str | None = None, days: int | None = None, query: str | None = None) -> DataFrame:
    """Notices (title, competition, site, excerpt, fields, date, group, is_competition, is_campus, deadline) by the facets
    that are set. scope: competition, campus, deadline, matched or unmatched."""
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    scopes = {"competition": F.col("is_competition"), "campus": F.col("is_campus"), "deadline": filled("deadline"), "matched": filled("competition"), "unmatched": ~filled("competition")}
    return reports.facet_filter(df, {
        "visible": visible(F.col("group"), hidden) if hidden else None, "group": F.col("group") == group if group else None, "scope": scopes[scope] if scope else None, "site": F.col("site") == site if site else None,
        "days": dates.days_since(F.col("date"), today) <= days if days is not None else None, "query": searched(query, *[F.col(c) for c in ("title", "competition", "site", "excerpt", "fields")]),
    })


def filter_articles(df: DataFrame, today: Column, *, group: str | None = None, account: str | None = None, days: int | None = None, query: str | None = None) -> DataFrame:
    return reports.facet_filter(df, {
        "group": F.col("group") == group if group else None, "account": F.col("account") == account if account else None, "days": dates.days_since(F.col("date"), today) <= days if days is not None else None,
        "query": searched(query, *[F.col(c) for c in ("title", "snippet", "account", "category")]),
    })


def filter_windows(df: DataFrame, *, least: int | None = None, month: int | None = None, query: str | None = None) -> DataFrame:
    """Competitions that have an activity window (window_start, window_end, score, name), by the facets that are set."""
    return reports.facet_filter(df.filter("window_start is not null"), {
        "least": F.col("score") >= least if least else None, "month": dates.in_window(F.lit(month), F.col("window_start"), F.col("window_end")) if month else None, "query": searched(query, F.col("name")),
    })


def filter_links(df: DataFrame, *, category: str | None = None, query: str | None = None) -> DataFrame:
    return reports.facet_filter(df, {"category": F.col("category") == category if category else None, "query": searched(query, F.col("name"), F.col("url"), F.col("desc"), F.col("category"), F.array_join("tags", " "))})


def visible(group: Column, hidden: tuple[str, ...]) -> Column:
    return ~F.coalesce(group, F.lit("")).isin(*hidden)


def evident_links(links: Column) -> Column:
    """Links (array of struct url, verification) that the text itself shows, of http or https."""
    return F.filter(links, lambda x: (x["verification"] == "source_matched") & x["url"].rlike("(?i)^https?://"))


def link_order(links: Column) -> Column:
    """Links (array of struct kind, ..) with forms first, then files, then others; equals keep their order."""
    rank = lambda x: F.when(x["kind"] == "form", 0).when(x["kind"] == "file", 1).otherwise(2)
    ranked = F.array_sort(F.transform(links, lambda x, i: F.struct(rank(x).alias("rank"), i.alias("at"), x.alias("link"))), lambda a, b: F.when((a["rank"] < b["rank"]) | ((a["rank"] == b["rank"]) & (a["at"] < b["at"])), -1).otherwise(1))
    return F.transform(ranked, lambda r: r["link"])


def by_name(name: str = "name", locale: str | None = None) -> Column:
    """The name as it sorts: by code points, or as the locale has it ("zh": by pinyin, other scripts behind)."""
    return F.collate(name, locale) if locale else F.col(name)


def competition_order(how: str, locale: str | None = None) -> list[Column]:
    """Orders of competitions (name, score, number, notices, latest_date, open_deadline, is_recruiting): score, deadline,
    recent, notices, number, name. What isn't known comes last; ties end with the name."""
    score, name = F.desc(F.coalesce(F.col("score"), F.lit(0))), by_name(locale=locale)
    deadline = F.nullif(F.coalesce(F.col("open_deadline"), F.lit("")), F.lit("")) if how == "deadline" else None
    return {
        "score": lambda: [score, name], "deadline": lambda: [F.desc(F.col("is_recruiting")), F.asc_nulls_last(deadline), score, name], "recent": lambda: [F.desc(F.coalesce(F.col("latest_date"), F.lit(""))), score, name],
        "notices": lambda: [F.desc(F.coalesce(F.col("notices"), F.lit(0))), score, name], "number": lambda: [F.coalesce(F.col("number"), F.lit(9999)), name], "name": lambda: [name],
    }[how]()


def window_order(how: str, locale: str | None = None) -> list[Column]:
    """Orders of competitions with a window: months, score, years."""
    score = F.desc(F.coalesce(F.col("score"), F.lit(0)))
    return {"months": [F.col("window_start"), score, by_name(locale=locale)], "score": [score, by_name(locale=locale)], "years": [F.desc("years_observed"), by_name(locale=locale)]}[how]


def cadence_order(locale: str | None = None) -> list[Column]:
    return [F.desc(F.coalesce(F.col("score"), F.lit(0))), F.desc("years_observed"), by_name(locale=locale)]


def date_order(newest_first: bool = True, then: str = "title") -> list[Column]:
    """By date, unknown dates last when the newest come first, then by title the same way."""
    day = F.coalesce(F.col("date"), F.lit(""))
    return [F.desc(day), F.desc(then)] if newest_first else [F.asc(day), F.asc(then)]


def edition_order() -> list[Column]:
    """Editions by year, number and latest notice, the newest first; unknown ones last."""
    return [F.desc(F.coalesce(F.col("year"), F.lit(0))), F.desc(F.coalesce(F.col("edition"), F.lit(0))), F.desc(F.coalesce(F.col("latest_date"), F.lit("")))]


def compact_rows(notices: DataFrame, slots: DataFrame, most: int = 30) -> DataFrame:
    """competition, url, title, date, dates: a competition's notices for its card, one of each group of reposts, newest
    first, those with a deadline before those without, at most so many, with what their slots say.

    notices: competition, url, title, date, group_url (its group's representative, null for none), deadline. slots: url,
    kind, value, state."""
    shown = notices.filter("group_url is null or group_url = url")
    turn = F.row_number().over(Window.partitionBy("competition").orderBy(F.desc(F.coalesce("date", F.lit(""))), F.desc(F.col("deadline").isNotNull()), "url"))
    kept = shown.withColumn("turn", turn).filter(F.col("turn") <= most)
    said = slots.groupBy("url").agg(F.array_join(F.transform(F.sort_array(F.collect_set(F.struct("value", "kind", "state"))), lambda s: F.concat_ws(" ", s["kind"], dates.deadline_text(s["value"]), F.when(s["state"] != "confirmed", s["state"]))), "; ").alias("dates"))
    return kept.join(said, "url", "left").select("competition", "url", "title", "date", F.coalesce("dates", F.lit("")).alias("dates"), "turn")


def same_entries(entries: DataFrame, by: list[str], members: list[str], source: str) -> DataFrame:
    """by, members, sources (array), n: entries that say the same in the same place, wherever they were read."""
    return entries.groupBy(*by, *members).agg(F.sort_array(F.collect_set(source)).alias("sources"), F.count("*").alias("n"))


def header_stats(competitions: DataFrame, least: int = 4) -> DataFrame:
    """total, recruiting, core (score of at least so much), with_notices, with_window in one pass."""
    count = lambda c, name: F.count_if(c).alias(name)
    return competitions.agg(F.count("*").alias("total"), count(F.col("is_recruiting"), "recruiting"), count(F.col("score") >= least, "core"), count(F.col("notices") > 0, "with_notices"), count(F.col("window_start").isNotNull(), "with_window"))


def counted(df: DataFrame, column: str, presets: list[str] | None = None) -> DataFrame:
    """column, n, position: presets that occur in their order, the others by number and name behind them."""
    made = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    place = F.coalesce(*[F.when(F.col(column) == p, F.lit(i)) for i, p in enumerate(presets or [])], F.lit(len(presets or [])))
    return made.withColumn("position", place).orderBy("position", F.desc("n"), column)


def events_of(editions: DataFrame, what: str) -> DataFrame:
    """competition, edition_id and one row for each of a nested collection: slots, entries, history or changes."""
    return editions.select("competition", "edition_id", F.explode(what).alias("x")).select("competition", "edition_id", "x.*")
