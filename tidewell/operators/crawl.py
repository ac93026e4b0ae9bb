"""What is to be fetched next, and what came of it: plans over stored tables; fetching itself isn't part of the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators import reports

#: Titles of registration and of contests, errors that may pass, and the states of a target.
SIGNUP = r"报名|参赛|选拔|补充|延期|延长|更正|调整|征集|组织参加"
CONTEST = r"竞赛|大赛|挑战杯"
TRANSIENT = r"(?i)Timeout|timed out|URLError|Connection|HTTP (?:429|5\d\d)"
STATES = ["success", "empty", "failed", "pending"]


def worth_fetching(is_competition: Column, date: Column, cutoff: Column) -> Column:
    """What is about a contest, whatever its age, and what is recent (ISO days compare as text)."""
    return F.coalesce(is_competition, F.lit(False)) | (F.coalesce(date, F.lit("")) >= cutoff)


def with_priority(notices: DataFrame, year: int, cutoff: str) -> DataFrame:
    """Notices (url, title, date, competition, is_competition) that are worth a request, with priority: 0 for this year's
    of a known competition, 1 for recent ones about its registration, 2 for recent ones about some contest's."""
    linked = F.coalesce("competition", F.lit("")) != ""
    date, title = F.coalesce("date", F.lit("")), F.coalesce("title", F.lit(""))
    this_year = date.startswith(str(year)) | title.rlike(rf"(?<!\d){year}(?!\d)")
    recent = (date >= cutoff) & title.rlike(SIGNUP)
    priority = F.when(linked & this_year, 0).when(linked & recent, 1).when(F.coalesce("is_competition", F.lit(False)) & recent & title.rlike(CONTEST), 2)
    return notices.withColumn("priority", priority).filter("priority is not null")


def plan_order() -> list[Column]:
    return [F.col("priority"), F.desc(F.coalesce("date", F.lit(""))), F.col("url")]


def still_to_do(candidates: DataFrame, cache: DataFrame, now: Column, force: bool = False, rest_hours: int | None = 24) -> DataFrame:
    """Candidates (url, ..) that aren't read yet. cache: url, status, has_html, content_hash, fetched_at. A success with
    its page and hash is done; a failure of the last hours rests; with force, nothing is."""
    if force:
        return candidates
    done = (F.col("status") == "success") & F.col("has_html") & (F.coalesce("content_hash", F.lit("")) != "")
    rests = (F.col("status") == "failed") & (F.col("fetched_at") > now - F.make_dt_interval(hours=F.lit(rest_hours))) if rest_hours else F.lit(False)
    return candidates.join(cache.filter(F.coalesce(done | rests, F.lit(False))).select("url"), "url", "left_anti")


def work_list(candidates: DataFrame, order: list[Column], limit: int | None = None, only: list[str] | None = None) -> DataFrame:
    """The candidates in a total order, or those of the given urls, or the first so many (a limit of the caller's)."""
    found = candidates.filter(F.col("url").isin(*only)) if only else candidates
    found = found.orderBy(*order)
    return found.limit(limit) if limit else found


def plan_by_status(targets: DataFrame, cache: DataFrame) -> DataFrame:
    """status, n over the four states; a target without a row in the cache is pending."""
    joined = targets.select("url").join(cache.select("url", "status"), "url", "left")
    return reports.zero_filled(joined.select(F.coalesce("status", F.lit("pending")).alias("status")), "status", STATES)


def attempts(history: DataFrame, most: int = 6) -> DataFrame:
    """url, status, error, attempts, recent (array, the last so many) of attempts (url, at, status, error)."""
    one = F.sort_array(F.collect_list(F.struct("at", "status", "error")))
    made = history.groupBy("url").agg(one.alias("all"))
    last = F.element_at("all", -1)
    return made.select("url", last["status"].alias("status"), last["error"].alias("error"), F.size("all").cast("long").alias("attempts"), F.slice("all", F.greatest(F.size("all") - most + 1, F.lit(1)), most).alias("recent"))


def next_try(status: Column, error: Column, made: Column, most: int = 2, longest: int = 4) -> Column:
    """Seconds to wait before the next attempt, doubling up to `longest`; null if there is none: only errors that may
    pass are tried again, and only so often."""
    again = (status == "failed") & F.coalesce(error, F.lit("")).rlike(TRANSIENT) & (made <= most)
    return F.when(again, F.least(F.pow(F.lit(2.0), made - 1), F.lit(float(longest))))


def outdated(cache: DataFrame, version: int) -> DataFrame:
    """Successful rows that an older parser made from a page that is still there: parsed again, never fetched again."""
    return cache.filter((F.col("status") == "success") & F.col("has_html") & (F.coalesce("parser_version", F.lit(0)) < version))


def queue_state(urls: DataFrame, history: DataFrame, most: int = 3) -> DataFrame:
    """url, state: success, failed (so many attempts without one) or pending, of a list of urls."""
    seen = history.groupBy("url").agg(F.count("*").alias("n"), F.bool_or(F.col("status") == "success").alias("ok"))
    joined = urls.select("url").distinct().join(seen, "url", "left")
    return joined.select("url", F.when(F.col("ok"), "success").when(F.col("n") >= most, "failed").otherwise("pending").alias("state"))


def import_match(assets: DataFrame, notice_url: str, asset_url: str | None = None) -> DataFrame:
    """The one asset that a file imported by hand belongs to; none or several stop the query."""
    found = assets.filter(F.col("notice_url") == notice_url)
    found = found.filter(F.col("url") == asset_url) if asset_url else found
    n = found.agg(F.count("*").alias("n"))
    checked = n.select(F.when(F.col("n") == 1, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("assets that match: "), F.col("n").cast("string")))).alias("one"))
    return found.crossJoin(F.broadcast(checked)).filter("one").drop("one")


def search_queries(accounts: DataFrame, topics: DataFrame) -> DataFrame:
    """query, seq: each account (account, a_seq) with each topic (topic, t_seq), each text once, in order. Both are short
    curated lists whose product is the list that is wanted."""
    made = accounts.crossJoin(topics).select(F.concat_ws(" ", "account", "topic").alias("query"), F.struct("a_seq", "t_seq").alias("seq"))
    return made.groupBy("query").agg(F.min("seq").alias("seq"))


def unknown_keys(wanted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Keys that were asked for and don't exist."""
    return wanted.select(key).distinct().join(known.select(key), key, "left_anti")
