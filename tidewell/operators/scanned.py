"""Text from scans: lines of words with their certainty, cleaned lines, candidates for addresses and sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import text

#: What makes a line hold an address, and links of lists of departments that lead nowhere.
ADDRESS = r"(?i)(https?|www\.|\.cn|\.edu)"
FRAGMENT = r"(?i)(\S*(?:https?://|www\.|\.edu)\S*)"
NO_SITE = r"(?i)^\s*(?:首页|主页|更多|more|home|english|返回|上一页|下一页|尾页)\s*$|^\s*$"


def lines_of_words(words: DataFrame, page: list[str], order: str, word: str, certainty: str) -> DataFrame:
    """page.., text, certainty: words of one line joined in order, spaces between Chinese characters taken out; a line is
    as sure as its least sure word. Words without text or with a negative certainty don't count."""
    real = words.filter((F.trim(F.coalesce(word, F.lit(""))) != "") & (F.col(certainty) >= 0))
    made = real.groupBy(*page).agg(F.sort_array(F.collect_list(F.struct(order, word))).alias("all"), F.min(certainty).alias("certainty"))
    joined = F.array_join(F.transform("all", lambda w: F.trim(w[word])), " ")
    return made.select(*page, text.despace_cjk(joined).alias("text"), "certainty")


def cleaned(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines trimmed, without spaces between Chinese characters; empty ones go."""
    return lines.withColumn(line, text.despace_cjk(F.trim(line))).filter(F.col(line) != "")


def address_candidates(lines: DataFrame, line: str = "line", order: str = "line_no", least: int = 6) -> DataFrame:
    """candidate, order: fragments that may be addresses, mended, each once whatever its case, as first written."""
    found = lines.filter(F.col(line).rlike(ADDRESS)).select(order, F.posexplode(F.regexp_extract_all(line, F.lit(FRAGMENT), 1)).alias("pos", "raw"))
    fine = found.withColumn("candidate", text.mended_url(F.col("raw"))).filter(F.length("candidate") >= least)
    return fine.groupBy(F.lower("candidate").alias("key")).agg(F.min(F.struct(order, "pos", "candidate")).alias("first")).select("first.candidate", F.col(f"first.{order}").alias(order))


def domain_counts(candidates: DataFrame, pattern: str) -> DataFrame:
    """domain, n: how many candidates hold a domain that the pattern's first group gives."""
    named = candidates.select(F.regexp_replace(F.regexp_extract("candidate", pattern, 1), r"^\.+|\.+$", "").alias("domain"))
    return named.filter("domain <> ''").groupBy("domain").agg(F.count("*").alias("n"))


def best_site(probes: DataFrame, key: str = "sub") -> DataFrame:
    """Of each key's probes (key, url, status) the one that answered, https before http; a number as status is an
    answer, anything else is an error."""
    ok = F.col("status").rlike(r"^\d+$")
    made = probes.withColumn("ok", ok).withColumn("secure", F.col("url").startswith("https"))
    return made.groupBy(key).agg(F.max_by(F.struct("url", "status", "ok"), F.struct("ok", "secure", "url")).alias("best")).select(key, "best.*")


def homepages(links: DataFrame, most: int = 2) -> DataFrame:
    """department, homepage: the first link (department, pos, href, label) of each department's page that few pages share
    and whose label doesn't lead elsewhere; null if there is none."""
    shared = links.groupBy("href").agg(F.count_distinct("department").alias("pages"))
    fine = links.join(shared, "href").filter((F.col("pages") <= most) & ~F.coalesce("label", F.lit("")).rlike(NO_SITE) & F.col("href").rlike("(?i)^https?://"))
    first = fine.groupBy("department").agg(F.min(F.struct("pos", "href")).getField("href").alias("homepage"))
    return links.select("department").distinct().join(first, "department", "left")


def hinted(linked: Column, hint: Column, known: Column) -> Column:
    """The competition that a title names, else the source's hint if it is a known one (known: whether it is)."""
    return F.coalesce(F.nullif(linked, F.lit("")), F.when(known, hint))


def article_state(html: Column, title: Column, day: Column, account: Column) -> Column:
    """Why an article that was handed in is no use: empty, blocked, no_title, or what is still missing; ok otherwise."""
    blocked = html.rlike(r"环境异常|访问过于频繁|验证|该内容已被发布者删除")
    return F.when(F.trim(F.coalesce(html, F.lit(""))) == "", "empty").when(F.coalesce(blocked, F.lit(False)), "blocked").when(F.coalesce(title, F.lit("")) == "", "no_title").when((F.coalesce(day, F.lit("")) == "") | (F.coalesce(account, F.lit("")) == ""), "incomplete").otherwise("ok")


def shape_errors(df: DataFrame, required: dict[str, str], allowed: dict[str, list[str]]) -> DataFrame:
    """The rows of df with `errors` (array): required columns that are null or empty, values outside their domain, and
    texts that don't cast to their type. required: column -> type; allowed: column -> values."""
    missing = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(f"missing {c}")) for c in required]
    wrong = [F.when(F.col(c).isNotNull() & F.col(c).cast("string").try_cast(kind).isNull(), F.lit(f"type {c}")) for c, kind in required.items()]
    outside = [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*values), F.lit(f"value {c}")) for c, values in allowed.items()]
    return df.withColumn("errors", F.array_compact(F.array(*missing, *wrong, *outside)))
