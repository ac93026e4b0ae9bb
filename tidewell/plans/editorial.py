"""Further queries over the driver tables: editions, diagnosis, assembly, plans and views, with the SQL they agree with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.functions import dates, facts, text
from tidewell.operators import assembly, crawl, diagnosis, editions, extraction, notices, ranking, views
from tidewell.plans.catalogue import NOW, query, spread, table



def today() -> Column:
    return F.to_date(F.lit(NOW))


def day() -> Column:
    return F.date_format("o_orderdate", "yyyy-MM-dd")


def ranked(df: DataFrame, key: str, order: list, name: str = "place") -> DataFrame:
    """key and its place in the order."""
    return ranking.numbered(df, [key], [*order, F.col(key)], name)


@query(
    "WITH n AS (SELECT CAST(o_orderkey AS VARCHAR) AS url, CAST(o_orderkey AS BIGINT) AS k, o_orderpriority AS title FROM orders), "
    "b AS (SELECT CAST(doc_id AS VARCHAR) AS url, text, CASE WHEN n_chars < 100 THEN 'failed' WHEN n_chars < 200 THEN 'odd' ELSE 'success' END AS s FROM documents) "
    "SELECT k AS o_orderkey, title, CASE WHEN b.url IS NULL THEN 'pending' WHEN s <> 'success' THEN 'failed' WHEN trim(coalesce(text, ''), ' ') = '' THEN 'empty' ELSE 'success' END AS fetch_status, "
    "CASE WHEN s = 'success' THEN CASE WHEN length(text) > 480 THEN substr(text, 1, 480) || '…' ELSE text END END AS excerpt FROM n LEFT JOIN b USING (url)"
)
def q59_notices_with_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("array<struct<url:string,text:string>>")
    status = F.when(F.col("n_chars") < 100, "failed").when(F.col("n_chars") < 200, "odd").otherwise("success")
    bodies = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("url"), status.alias("status"), F.lit("").alias("error"), F.lit(None).cast("timestamp").alias("fetched_at"), F.col("text").alias("body"), none.alias("attachments"), none.alias("form_links"))
    notices = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("url"), F.col("o_orderpriority").alias("title"))
    return assembly.with_bodies(notices, assembly.body_columns(bodies)).select("o_orderkey", "title", "fetch_status", "excerpt")


@query(
    "SELECT event_id, CASE WHEN value < 50 THEN value * 2 ELSE value END AS facts, CASE WHEN value < 50 AND event_type <> 'error' THEN 'rules' WHEN value < 50 THEN 'rules' ELSE 'saved' END AS origin FROM events"
)
def q60_current_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved facts count only while the content hash is that of the body; the hash of small values has changed."""
    e = table(spark, sf_dir, "events")
    bodies = e.select(F.col("event_id").alias("url"), F.col("event_type").alias("content_hash"))
    saved = e.select(F.col("event_id").alias("url"), F.when(F.col("value") < 50, "old").otherwise(F.col("event_type")).alias("content_hash"), F.col("value").alias("facts"), F.lit(True).alias("valid"))
    fresh = e.select(F.col("event_id").alias("url"), (F.col("value") * 2).alias("facts"))
    return assembly.current_facts(bodies, saved, fresh).select(F.col("url").alias("event_id"), "facts", "origin")


NAMES_SQL = (
    "WITH r AS (SELECT p_partkey AS row_id, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS r, p_size AS no, p_name, p_type, p_brand FROM part), "
    "n AS (SELECT s_suppkey AS name_id, CASE WHEN s_acctbal < 2000 THEN 'ring' WHEN s_acctbal < 5000 THEN 'the red widget' WHEN s_acctbal < 9000 THEN 'small bolt' ELSE s_name END AS name, CASE WHEN s_acctbal > 9500 THEN s_nationkey END AS want FROM supplier), "
    "k AS (SELECT *, regexp_replace(lower(name), '[^a-z0-9#]', '', 'g') AS n FROM n), a AS (SELECT name_id, min(row_id) AS row_id FROM k JOIN r ON r.no = k.want GROUP BY 1), "
    "b AS (SELECT name_id, min(row_id) AS row_id FROM k JOIN r ON k.n = r.r OR (length(k.n) >= 6 AND length(r.r) >= 6 AND (contains(k.n, r.r) OR contains(r.r, k.n))) WHERE name_id NOT IN (SELECT name_id FROM a) GROUP BY 1), "
    "m AS (SELECT * FROM a UNION ALL SELECT * FROM b)"
)


def names_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    name = F.when(F.col("s_acctbal") < 2000, "ring").when(F.col("s_acctbal") < 5000, "the red widget").when(F.col("s_acctbal") < 9000, "small bolt").otherwise(F.col("s_name"))
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("name_id"), name.alias("name"), F.when(F.col("s_acctbal") > 9500, F.col("s_nationkey")).alias("no"), F.col("s_name").alias("contact"), F.lit("").alias("note"))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), F.col("p_name").alias("name"), F.col("p_size").alias("no"), F.col("p_type").alias("category"), F.lit("").alias("contact"), F.col("p_brand").alias("source"), F.lit("").alias("reason"))
    return rows, names


@query(NAMES_SQL + " SELECT CAST(name_id AS BIGINT) AS name_id, CAST(row_id AS BIGINT) AS row_id FROM m")
def q61_match_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, names = names_of(spark, sf_dir)
    return assembly.match_names(rows, names).select(F.col("name_id").cast("long").alias("name_id"), F.col("row_id").cast("long").alias("row_id"))


@query(
    NAMES_SQL + ", l AS (SELECT row_id, max(name_id) AS last FROM m GROUP BY 1), x AS (SELECT p_name AS name, CASE WHEN l.row_id IS NOT NULL AND p_type = 'ECONOMY' THEN 'C' ELSE p_type END AS category, coalesce(s_name, '') AS contact, "
    "CASE WHEN l.row_id IS NOT NULL THEN p_brand || '+list' ELSE p_brand END AS source FROM r LEFT JOIN l USING (row_id) LEFT JOIN supplier ON s_suppkey = l.last), "
    "u AS (SELECT * FROM x UNION ALL SELECT k.name, 'C', s_name, 'list' FROM k JOIN supplier ON s_suppkey = k.name_id WHERE name_id NOT IN (SELECT name_id FROM m)) SELECT category, source, count(*) AS n, count(DISTINCT name) AS names, max(contact) AS contact FROM u GROUP BY 1, 2"
)
def q62_master_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, names = names_of(spark, sf_dir)
    merged = assembly.merge_list(rows, names, "C", "list", "ECONOMY")
    return merged.groupBy("category", "source").agg(F.count("*").alias("n"), F.count_distinct("name").alias("names"), F.max("contact").alias("contact"))


@query(
    "WITH u AS (SELECT 0 AS part, page_id AS seq, url, regexp_extract(html, '<html lang=\"([a-z]*)\"', 1) AS category, 'page' AS name FROM pages UNION ALL SELECT 1, n_nationkey, 'https://www.' || lower(n_name) || '.example.com/', ' 1. extra', n_name FROM nation), "
    "k AS (SELECT *, regexp_replace(regexp_replace(lower(trim(url)), '^https?://(www\\.)?', ''), '/+$', '') AS key FROM u), f AS (SELECT * FROM k WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY key ORDER BY part, seq) = 1), "
    "g AS (SELECT *, CASE WHEN part = 1 THEN CASE WHEN key = 'nation_3.example.com' THEN 'fixed' ELSE 'more' END WHEN category = '' THEN 'other' ELSE category END AS cat FROM f), "
    "h AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY part, seq) AS rn FROM g) SELECT key, cat AS category, CASE WHEN rn > 1 THEN name || ' (' || regexp_extract(key, '^([^./]*)', 1) || ')' ELSE name END AS name FROM h"
)
def q63_merge_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("seq"), "url", F.regexp_extract("html", '<html lang="([a-z]*)"', 1).alias("category"), F.lit("page").alias("name"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("seq"), F.concat(F.lit("https://www."), F.lower("n_name"), F.lit(".example.com/")).alias("url"), F.lit(" 1. extra").alias("category"), F.col("n_name").alias("name"))
    overrides = spark.createDataFrame([("http://nation_3.example.com", "fixed", None)], "url string, category string, name string")
    links, _ = assembly.merge_links([pages, nations], {"extra": "more"}, overrides, "other", ["en", "de"], "more")
    return links.select("key", "category", "name")


COVERAGE_RULES = [(0, "widget", False, ["a", "b"]), (1, "red", False, ["b", "c"]), (2, "ring", True, ["d"]), (3, "small ring", True, ["d", "a"])]


@query(
    "WITH r AS (SELECT * FROM (VALUES (0, 'widget', false, ['a', 'b']), (1, 'red', false, ['b', 'c']), (2, 'ring', true, ['d']), (3, 'small ring', true, ['d', 'a'])) AS r(rank, keyword, exact, keys)), c AS (SELECT DISTINCT p_name AS competition FROM part), "
    "x AS (SELECT competition, rank, unnest(keys) AS key, unnest(range(1, len(keys) + 1)) AS pos FROM c JOIN r ON CASE WHEN exact THEN competition = keyword ELSE contains(competition, keyword) END), "
    "f AS (SELECT competition, key, min(rank * 100 + pos) AS place FROM x GROUP BY 1, 2), s AS (SELECT 'a' AS key, CAST(max(o_orderdate) AS DATE) AS last_run FROM orders) "
    "SELECT competition, string_agg(f.key || ':' || coalesce(strftime(s.last_run, '%Y-%m-%d'), '-'), ' ' ORDER BY place) AS sources FROM f LEFT JOIN s USING (key) GROUP BY 1"
)
def q64_source_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(COVERAGE_RULES, "rank int, keyword string, exact boolean, keys array<string>")
    status = table(spark, sf_dir, "orders").agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_run")).withColumn("key", F.lit("a"))
    made = assembly.source_coverage(table(spark, sf_dir, "part").select(F.col("p_name").alias("competition")).distinct(), rules, status)
    return made.select("competition", F.array_join(F.transform("sources", lambda s: F.concat(s["key"], F.lit(":"), F.coalesce(s["last_run"], F.lit("-")))), " ").alias("sources"))


@query(
    "WITH o AS (SELECT o_orderkey AS url, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS was FROM orders WHERE o_orderstatus <> 'O'), b AS (SELECT o_orderkey AS url, CASE o_orderstatus WHEN 'O' THEN 'success' ELSE 'failed' END AS s FROM orders WHERE o_orderstatus <> 'F'), "
    "d AS (SELECT l_orderkey AS url, CASE WHEN count(DISTINCT l_shipdate) = 1 THEN strftime(min(l_shipdate), '%Y-%m-%d') END AS safe FROM lineitem GROUP BY 1), j AS (SELECT coalesce(o.url, b.url) AS url, was, s FROM o FULL JOIN b ON o.url = b.url) "
    "SELECT url, CASE WHEN s = 'success' THEN safe END AS deadline, CAST(CASE WHEN s = 'success' AND safe IS NOT NULL THEN 4 ELSE 0 END AS BIGINT) AS score, CASE WHEN s IS NULL THEN was END AS legacy FROM j LEFT JOIN d USING (url)"
)
def q65_deadline_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "url")
    old = orders.filter("o_orderstatus <> 'O'").select("url", F.when(F.col("o_orderstatus") == "F", day()).alias("deadline"), F.lit("").alias("legacy"))
    bodies = orders.filter("o_orderstatus <> 'F'").select("url", F.when(F.col("o_orderstatus") == "O", "success").otherwise("failed").alias("status"))
    safe = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("url")).agg(F.when(F.min("l_shipdate") == F.max("l_shipdate"), F.date_format(F.min("l_shipdate"), "yyyy-MM-dd")).alias("safe"))
    return assembly.deadline_table(old, bodies, safe).select("url", "deadline", F.col("score").cast("long").alias("score"), "legacy")


@query(
    f"WITH n AS (SELECT o_custkey AS c, o_orderkey AS url, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderpriority = '1-URGENT' AS campus FROM orders), r AS (SELECT o_custkey AS c, bool_or(o_orderstatus = 'O') AS open, max(strftime(o_orderdate, '%Y-%m-%d')) AS next, list(o_orderkey) FILTER (o_orderstatus = 'O') AS urls FROM orders GROUP BY 1), "
    "s AS (SELECT c, count(*) AS notices, count_if(campus) AS campus_notices, arg_max(url, (d, url)) AS latest FROM n GROUP BY 1), "
    f"x AS (SELECT n.c, arg_max(n.url, (d, n.url)) AS pick FROM n JOIN r USING (c) WHERE campus AND open AND list_contains(urls, n.url) AND date_diff('day', CAST(d AS DATE), DATE '{NOW}') BETWEEN 0 AND 120 GROUP BY 1) "
    "SELECT c_custkey, CAST(coalesce(notices, 0) AS BIGINT) AS notices, CAST(coalesce(campus_notices, 0) AS BIGINT) AS campus_notices, CAST(latest AS DOUBLE) AS latest, CASE WHEN open THEN next ELSE '' END AS open_deadline, coalesce(open, false) AS is_open, pick IS NOT NULL AS is_selecting, coalesce(open, false) OR pick IS NOT NULL AS is_recruiting "
    "FROM customer LEFT JOIN s ON s.c = c_custkey LEFT JOIN r ON r.c = c_custkey LEFT JOIN x ON x.c = c_custkey"
)
def q66_recruiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "competition")
    notices = orders.select("competition", F.col("o_orderkey").alias("url"), day().alias("date"), (F.col("o_orderpriority") == "1-URGENT").alias("is_campus"))
    is_open = F.col("o_orderstatus") == "O"
    registration = orders.groupBy("competition").agg(F.when(F.bool_or(is_open), "open").otherwise("closed").alias("status"), F.max(day()).alias("next_deadline"), F.collect_list(F.when(is_open, F.col("o_orderkey"))).alias("open_urls"))
    made = assembly.recruiting(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("competition")), registration, notices, today())
    return made.select(F.col("competition").alias("c_custkey"), "notices", "campus_notices", F.col("latest").cast("double").alias("latest"), "open_deadline", "is_open", "is_selecting", "is_recruiting")


def edition_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as notices of their customer: those of status O tell year and edition, F the year, P the edition alone."""
    year, status = F.year("o_orderdate"), F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("url"), F.col("o_custkey").alias("competition"), F.when(status != "P", year).alias("year"), F.when(status != "P", year).alias("year_end"), F.when(status != "F", year - 1990).alias("edition"),
        (F.col("o_orderpriority") == "5-LOW").alias("ambiguous"), F.when(F.col("o_orderpriority") == "2-HIGH", "t").alias("track"), F.lit("title").alias("method"), day().alias("date"), "o_orderkey",
    )


NOTICES_SQL = (
    "WITH n AS (SELECT o_orderkey, o_custkey AS c, CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate) END AS y, CASE WHEN o_orderstatus <> 'F' THEN year(o_orderdate) - 1990 END AS e, o_orderpriority = '5-LOW' AS amb, CASE WHEN o_orderpriority = '2-HIGH' THEN 't' END AS t, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)"
)


@query(
    NOTICES_SQL + ", a AS (SELECT DISTINCT c, t, y, e FROM n WHERE NOT amb AND y IS NOT NULL AND e IS NOT NULL), "
    "b AS (SELECT o_orderkey, min(a.y) AS ay, min(a.e) AS ae FROM n JOIN a ON a.c = n.c AND a.t IS NOT DISTINCT FROM n.t AND (n.y IS NULL OR n.y = a.y) AND (n.e IS NULL OR n.e = a.e) WHERE NOT amb AND (n.y IS NOT NULL OR n.e IS NOT NULL) GROUP BY 1 HAVING count(DISTINCT (a.y, a.e)) = 1) "
    "SELECT o_orderkey, CASE WHEN NOT amb THEN CAST(coalesce(ay, y) AS DOUBLE) END AS edition_year, CASE WHEN NOT amb THEN CAST(coalesce(ae, e) AS DOUBLE) END AS edition_no, CASE WHEN coalesce(ay, y) IS NOT NULL AND NOT amb THEN 'confirmed' ELSE 'needs_review' END AS identity_state, "
    "CASE WHEN ay IS NOT NULL AND (y IS DISTINCT FROM ay OR e IS DISTINCT FROM ae) THEN 'explicit_anchor' ELSE 'title' END AS identity_method FROM n LEFT JOIN b USING (o_orderkey)"
)
def q67_assign_editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = editions.assign_editions(edition_notices(spark, sf_dir))
    return made.select("o_orderkey", F.col("edition_year").cast("double").alias("edition_year"), F.col("edition_no").cast("double").alias("edition_no"), "identity_state", "identity_method")


@query(
    NOTICES_SQL + ", r AS (SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS target, o_totalprice > 100000 AS fine FROM orders), "
    "p AS (SELECT n.o_orderkey, m.y AS ty, m.e AS te FROM n JOIN r ON r.o_orderkey = n.o_orderkey AND fine JOIN n m ON m.o_orderkey = r.target WHERE NOT n.amb AND NOT (n.y IS NOT NULL AND n.e IS NOT NULL) AND NOT m.amb AND m.y IS NOT NULL AND (n.t IS NULL OR m.t IS NULL OR n.t = m.t)), "
    "x AS (SELECT n.*, p.ty, p.te, p.o_orderkey IS NOT NULL AS told, coalesce(n.y <> p.ty, false) OR (p.o_orderkey IS NOT NULL AND n.e IS NOT NULL AND n.e IS DISTINCT FROM p.te) AS clash FROM n LEFT JOIN p USING (o_orderkey)) "
    "SELECT o_orderkey, CAST(CASE WHEN told AND NOT clash THEN ty ELSE y END AS DOUBLE) AS year, CAST(CASE WHEN told AND NOT clash THEN te ELSE e END AS DOUBLE) AS edition, amb OR clash AS ambiguous, CASE WHEN told AND NOT clash THEN 'explicit_reference' ELSE 'title' END AS method FROM x"
)
def q68_resolve_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order refers to the one before it of the same customer; cheap ones to an earlier edition."""
    before = F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    references = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("url"), before.cast("string").alias("target"), F.when(F.col("o_totalprice") > 100000, "根据本届通知").otherwise("往届通知").alias("raw")).filter("target is not null")
    made = editions.resolve_references(edition_notices(spark, sf_dir), references)
    return made.select("o_orderkey", F.col("year").cast("double").alias("year"), F.col("edition").cast("double").alias("edition"), "ambiguous", "method")


@query(
    f"WITH d AS (SELECT o_custkey AS e, o_orderpriority AS t, max(o_orderdate) AS v, count(DISTINCT o_orderdate) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2), s AS (SELECT o_custkey AS e, o_orderpriority AS t, bool_or(o_orderdate > TIMESTAMP '{NOW}') AS ahead, count(DISTINCT o_orderdate) > 1 AS unsure FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2), "
    "r AS (SELECT o_custkey AS e, o_orderpriority AS t, max(o_orderdate) AS d FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2) "
    f"SELECT d.e AS edition_id, d.t AS track, CASE WHEN n > 1 THEN 'conflict' WHEN coalesce(unsure, false) THEN 'needs_review' WHEN r.d >= v OR v + INTERVAL 86399 SECOND <= TIMESTAMP '{NOW}' THEN 'closed' WHEN coalesce(ahead, false) THEN 'not_started' ELSE 'open' END AS status FROM d LEFT JOIN s USING (e, t) LEFT JOIN r USING (e, t)"
)
def q69_slot_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deadlines (status O), starts (P) and results (F) of customers by priority as track."""
    orders = table(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderstatus") == "O", "registration_deadline").otherwise("registration_start")
    none = F.lit(None).cast("string")
    entry = F.struct(F.col("o_orderkey").cast("string"), day(), day(), none, none, F.lit("x"), F.array().cast("array<string>"), F.lit("source_matched")).cast(editions.ENTRY)
    made = orders.filter("o_orderstatus <> 'F'").groupBy(F.col("o_custkey").alias("edition_id"), kind.alias("kind"), F.col("o_orderpriority").alias("track")).agg(F.sort_array(F.collect_list(F.struct("o_orderdate", "o_orderkey", entry.alias("x")))).alias("all"))
    made = made.select("edition_id", "kind", "track", none.alias("phase"), none.alias("stage"), F.transform("all", lambda a: a["x"]).alias("entries")).withColumn("state", editions.entry_state(F.col("entries")))
    results = orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("edition_id"), F.col("o_orderkey").cast("string").alias("url"), day().alias("date"), F.lit("获奖名单").alias("title"), F.lit("results").alias("notice_type"), none.alias("phase"), none.alias("stage"), F.col("o_orderpriority").alias("track"))
    return editions.slot_status(made, results, F.to_timestamp_ntz(F.lit(NOW))).select("edition_id", "track", "status")


EDITIONS_SQL = (
    f"WITH e AS (SELECT o_custkey AS c, year(o_orderdate) AS y, min(strftime(o_orderdate, '%Y-%m-%d')) AS f, CASE WHEN bool_or(o_orderstatus = 'O') THEN 'open' WHEN bool_or(o_orderstatus = 'P') THEN 'conflict' ELSE 'closed' END AS s, bool_or(o_orderpriority = '1-URGENT') AS sure, max(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) AS k FROM orders GROUP BY 1, 2), "
    f"l AS (SELECT c, max(y) AS ly FROM e WHERE sure AND y >= 1998 AND f <= '{NOW}' GROUP BY 1), x AS (SELECT e.*, coalesce(sure AND y >= 1998 AND f <= '{NOW}' AND y = ly, false) AS current FROM e LEFT JOIN l USING (c))"
)


@query(
    EDITIONS_SQL + " SELECT c AS o_custkey, CASE WHEN bool_or(current) THEN CASE WHEN bool_or(current AND s = 'open') THEN 'open' WHEN bool_or(current AND s = 'conflict') THEN 'conflict' ELSE 'closed' END WHEN bool_or(NOT sure) THEN 'needs_review' ELSE 'not_mentioned' END AS status, count_if(current)::BIGINT AS editions, "
    "CAST(max(CASE WHEN current AND s = 'open' THEN k END) AS VARCHAR) AS next_deadline FROM x GROUP BY 1"
)
def q70_competition_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders of a year are an edition."""
    has = lambda s: F.bool_or(F.col("o_orderstatus") == s)
    status = F.when(has("O"), "open").when(has("P"), "conflict").otherwise("closed")
    key = F.max(F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey"))).cast("string")
    made = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("competition"), F.year("o_orderdate").alias("year")).agg(F.min(day()).alias("first_date"), status.alias("status"), F.when(F.bool_or(F.col("o_orderpriority") == "1-URGENT"), "confirmed").otherwise("needs_review").alias("identity_state"), key.alias("k"))
    made = made.withColumn("edition_id", F.concat_ws("-", "competition", "year")).withColumn("year_end", F.col("year")).withColumn("open_nodes", F.when(F.col("status") == "open", F.array(F.struct(F.col("k").alias("value"), F.col("k").alias("url")))))
    now = editions.current_editions(made, F.to_timestamp_ntz(F.lit(NOW)))
    return editions.competition_registration(now).select(F.col("competition").alias("o_custkey"), "status", F.size("current_ids").cast("long").alias("editions"), "next_deadline")


CHECKS_SQL = (
    "WITH c AS (SELECT doc_id AS url, source AS e, lang AS c, CASE WHEN coalesce(text, '') = '' THEN 'body_empty' WHEN n_chars < 300 THEN 'fetch_failed' WHEN n_chars < 600 THEN 'fields_pending' ELSE 'confirmed' END AS s FROM documents)"
)


def checks_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as notices of editions (their sources) of competitions (their languages)."""
    status = F.when(F.coalesce("text", F.lit("")) == "", "empty").when(F.col("n_chars") < 300, "failed").otherwise("success")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("url"), F.col("source").alias("edition_id"), F.col("lang").alias("competition"), diagnosis.notice_state(status, F.lit(""), F.col("n_chars") >= 600).alias("state"), status.alias("status"), (F.col("n_chars") >= 600).alias("has_fields"))


@query(
    CHECKS_SQL + ", g AS (SELECT e, count_if(s = 'fetch_failed') AS ff, count_if(s = 'body_empty') AS be, count_if(s = 'fields_pending') AS fp FROM c GROUP BY 1), h AS (SELECT e, max(CASE WHEN toxic = 1 THEN 2 ELSE 1 END) AS w FROM c JOIN labels ON doc_id = url WHERE quality = 0 OR toxic = 1 GROUP BY 1), "
    "x AS (SELECT g.e, CASE WHEN ff > 0 THEN 'fetch_failed' WHEN be > 0 THEN 'body_empty' WHEN fp > 0 THEN 'fields_pending' WHEN w = 2 THEN 'resource_failed' WHEN w = 1 THEN 'resource_pending' ELSE 'not_extracted' END AS groups, array_to_string(list_filter([CASE WHEN ff > 0 THEN 'fetch_failed' END, CASE WHEN be > 0 THEN 'body_empty' END, CASE WHEN fp > 0 THEN 'fields_pending' END], lambda z: z IS NOT NULL), ',') AS gaps, ff + be + fp > 0 AS any_gap, w FROM g LEFT JOIN h USING (e)) "
    "SELECT e AS source, groups, 'conflict' AS deadline, CASE WHEN gaps = '' THEN 'conflict' ELSE gaps || ',conflict' END || CASE WHEN any_gap THEN '' WHEN w = 2 THEN ',resource_failed' WHEN w = 1 THEN ',resource_pending' ELSE '' END || CASE WHEN any_gap THEN '' ELSE ',not_extracted' END AS reasons, 'conflict' AS primary_reason, any_gap AS partial FROM x"
)
def q71_edition_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad and toxic documents stand for notices whose attachments about groups weren't read."""
    checks = checks_of(spark, sf_dir)
    hints = table(spark, sf_dir, "labels").filter("quality = 0 or toxic = 1").select(F.col("doc_id").alias("url"), F.when(F.col("toxic") == 1, "resource_failed").otherwise("resource_pending").alias("state"), F.array(F.lit("groups")).alias("fields"))
    known = checks.select("edition_id").distinct()
    states = known.select("edition_id", F.lit("deadline").alias("field"), F.lit("conflict").alias("state")).unionByName(known.select("edition_id", F.lit("audiences").alias("field"), F.lit("confirmed").alias("state")))
    made = diagnosis.edition_diagnosis(checks, hints, states)
    return made.select(F.col("edition_id").alias("source"), F.col("field_states")["groups"].alias("groups"), F.col("field_states")["deadline"].alias("deadline"), F.array_join("reasons", ",").alias("reasons"), F.col("primary").alias("primary_reason"), "partial")


@query(
    CHECKS_SQL + ", k AS (SELECT c, count(*) AS n, bool_or(s = 'fields_pending') AS unsure FROM c GROUP BY 1), x AS (SELECT c, count(*) AS cn FROM c WHERE e = 'web' OR e = 'hot' GROUP BY 1), a AS (SELECT lang AS c FROM documents UNION SELECT 'none') "
    "SELECT a.c AS competition, CASE WHEN n IS NULL THEN 'no_notices' WHEN cn IS NULL THEN 'no_current_notice' ELSE 'needs_review' END AS primary_reason, CASE WHEN n IS NULL THEN 'no_notices' WHEN cn IS NULL THEN CASE WHEN unsure THEN 'no_current_notice,identity_unknown' ELSE 'no_current_notice' END ELSE 'needs_review,not_extracted' END AS reasons, "
    "CAST(coalesce(n, 0) AS BIGINT) AS notices FROM a LEFT JOIN k ON k.c IS NOT DISTINCT FROM a.c LEFT JOIN x ON x.c IS NOT DISTINCT FROM a.c"
)
def q72_competition_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = checks_of(spark, sf_dir).withColumn("identity_state", F.when(F.col("state") == "fields_pending", "needs_review").otherwise("confirmed")).withColumn("conflicts", F.array().cast("array<string>"))
    names = checks.select("competition").distinct().union(spark.createDataFrame([("none",)], "competition string"))
    now = checks.select("competition", "edition_id").distinct().select("competition", "edition_id", F.col("edition_id").isin("web", "hot").alias("current"), F.array(F.lit("needs_review"), F.lit("not_extracted")).alias("reasons"))
    made = diagnosis.competition_diagnosis(names, checks, now)
    return made.select("competition", F.col("primary").alias("primary_reason"), F.array_join("reasons", ",").alias("reasons"), "notices")


@query(
    CHECKS_SQL + ", t AS (SELECT CASE s WHEN 'body_empty' THEN 'empty' WHEN 'fetch_failed' THEN 'failed' ELSE 'success' END AS s, s = 'confirmed' OR (s = 'body_empty' AND false) AS f FROM c) "
    "SELECT count(*) AS total, count_if(s = 'success')::BIGINT AS success, count_if(s = 'failed')::BIGINT AS failed, count_if(s = 'empty')::BIGINT AS \"empty\", CAST(0 AS BIGINT) AS pending, count_if(f)::BIGINT AS with_fields, round(count_if(s = 'success') / count(*), 4) AS rate FROM t"
)
def q73_fetch_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnosis.fetch_coverage(checks_of(spark, sf_dir))


@query(
    "WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderstatus = 'F' AS linked, o_orderpriority LIKE '1%' AS comp, CASE o_orderpriority WHEN '2-HIGH' THEN '报名通知' WHEN '1-URGENT' THEN '竞赛报名' ELSE o_orderpriority END AS title FROM orders), "
    "p AS (SELECT *, CASE WHEN linked AND d LIKE '1998%' THEN 0 WHEN linked AND d >= '1997-06-01' AND contains(title, '报名') THEN 1 WHEN comp AND d >= '1997-06-01' AND contains(title, '竞赛') THEN 2 END AS priority FROM o) "
    "SELECT o_orderkey, CAST(priority AS BIGINT) AS priority, row_number() OVER (ORDER BY priority, d DESC, CAST(o_orderkey AS VARCHAR)) AS place FROM p WHERE priority IS NOT NULL QUALIFY place <= 100"
)
def q74_fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.when(F.col("o_orderpriority") == "2-HIGH", "报名通知").when(F.col("o_orderpriority") == "1-URGENT", "竞赛报名").otherwise(F.col("o_orderpriority"))
    notices = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("url"), day().alias("date"), F.when(F.col("o_orderstatus") == "F", "c").alias("competition"), F.col("o_orderpriority").startswith("1").alias("is_competition"), title.alias("title"))
    top = crawl.work_list(crawl.with_priority(notices, 1998, "1997-06-01"), crawl.plan_order(), 100)
    return top.select("o_orderkey", F.col("priority").cast("long").alias("priority"), F.row_number().over(Window.orderBy(*crawl.plan_order())).cast("long").alias("place"))


@query(
    "WITH a AS (SELECT user_id, count(*) AS n, arg_max(event_type, (ts, event_type)) AS s FROM events GROUP BY 1), r AS (SELECT user_id, event_type, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) AS rn FROM events) "
    "SELECT a.user_id, s AS status, n AS attempts, (SELECT string_agg(event_type, ',' ORDER BY rn DESC) FROM r WHERE r.user_id = a.user_id AND rn <= 6) AS recent FROM a"
)
def q75_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = table(spark, sf_dir, "events").select(F.col("user_id").alias("url"), F.col("ts").alias("at"), F.col("event_type").alias("status"), F.lit("").alias("error"))
    made = crawl.attempts(history)
    return made.select(F.col("url").alias("user_id"), "status", "attempts", F.array_join(F.transform("recent", lambda a: a["status"]), ",").alias("recent"))


@query(
    "WITH l AS (SELECT user_id, max(ts) AS at, arg_max(event_type, (ts, event_type)) AS status FROM events GROUP BY 1), s AS (SELECT user_id, max(ts) AS ok FROM events WHERE event_type = 'success' OR event_type = 'purchase' GROUP BY 1) "
    "SELECT l.user_id, l.at, CASE l.status WHEN 'purchase' THEN 'success' ELSE l.status END AS status, s.ok AS last_success FROM l LEFT JOIN s USING (user_id)"
)
def q76_last_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "purchase", "success").otherwise(F.col("event_type"))
    made = assembly.last_success(table(spark, sf_dir, "events").select("user_id", F.col("ts").alias("at"), status.alias("status")), "user_id")
    return made.select("user_id", "at", "status", F.col("last_success.at").alias("last_success"))


SORTED_SQL = (
    f"WITH o AS (SELECT o_custkey, count(*) AS notices, max(strftime(o_orderdate, '%Y-%m-%d')) AS latest, min(CASE WHEN o_orderstatus = 'O' AND o_orderdate > TIMESTAMP '{NOW}' THEN strftime(o_orderdate, '%Y-%m-%d') END) AS deadline FROM orders GROUP BY 1), "
    "c AS (SELECT c_custkey, c_name AS name, CASE WHEN c_acctbal > 0 THEN CAST(floor(c_acctbal / 2000) AS INT) END AS score, CASE WHEN c_nationkey > 4 THEN c_nationkey END AS number, coalesce(notices, 0) AS notices, latest, deadline FROM customer LEFT JOIN o ON o_custkey = c_custkey)"
)


@query(
    SORTED_SQL + " SELECT c_custkey, row_number() OVER (ORDER BY coalesce(score, 0) DESC, name, c_custkey) AS by_score, row_number() OVER (ORDER BY (deadline IS NOT NULL) DESC, deadline NULLS LAST, coalesce(score, 0) DESC, name, c_custkey) AS by_deadline, "
    "row_number() OVER (ORDER BY coalesce(latest, '') DESC, coalesce(score, 0) DESC, name, c_custkey) AS by_recent, row_number() OVER (ORDER BY notices DESC, coalesce(score, 0) DESC, name, c_custkey) AS by_notices, "
    "row_number() OVER (ORDER BY coalesce(number, 9999), name, c_custkey) AS by_number, row_number() OVER (ORDER BY coalesce(score, -1) DESC, coalesce(number, 999), name, c_custkey) AS by_master FROM c"
)
def q77_sorted_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = competitions_of(spark, sf_dir)
    out = ranked(c, "c_custkey", assembly.master_order(number="number"), "by_master")
    for how in ("score", "deadline", "recent", "notices", "number"):
        out = out.join(ranked(c, "c_custkey", views.competition_order(how), f"by_{how}"), "c_custkey")
    return out


def competitions_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    ahead = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") > F.to_timestamp_ntz(F.lit(NOW)))
    seen = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("notices"), F.max(day()).alias("latest_date"), F.min(F.when(ahead, day())).alias("open_deadline"))
    c = table(spark, sf_dir, "customer").join(seen, F.col("c_custkey") == F.col("o_custkey"), "left")
    return c.select(
        "c_custkey", F.col("c_name").alias("name"), F.when(F.col("c_acctbal") > 0, F.floor(F.col("c_acctbal") / 2000).cast("int")).alias("score"), F.when(F.col("c_nationkey") > 4, F.col("c_nationkey")).alias("number"), F.coalesce("notices", F.lit(0)).alias("notices"), "latest_date", "open_deadline",
        F.col("open_deadline").isNotNull().alias("is_recruiting"), F.col("c_mktsegment").alias("category"), *[F.lit("").alias(x) for x in ("alias", "organizer", "reason", "dept", "domain", "contact")],
    )


@query(SORTED_SQL + f" SELECT c_custkey FROM c WHERE deadline IS NOT NULL AND score >= 2 AND number IS NOT NULL AND date_diff('day', CAST(latest AS DATE), DATE '{NOW}') <= 90 AND contains(name || ' ' || number, '1')")
def q78_filter_competitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.filter_competitions(competitions_of(spark, sf_dir), today(), "FURNITURE", is_open=True, least=2, in_catalogue=True, recent=True, query="1").select("c_custkey")


@query(
    f"SELECT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderstatus = 'F' AND o_totalprice > 200000 AND date_diff('day', o_orderdate, TIMESTAMP '{NOW}') <= 365 AND contains(CAST(o_custkey AS VARCHAR), '7')"
)
def q79_filter_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = F.lit("")
    notices = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("title"), empty.alias("competition"), empty.alias("site"), empty.alias("excerpt"), empty.alias("fields"), day().alias("date"), F.col("o_orderpriority").alias("group"), (F.col("o_orderstatus") == "F").alias("is_competition"),
        F.lit(False).alias("is_campus"), F.when(F.col("o_totalprice") > 200000, "x").otherwise("").alias("deadline"),
    )
    found = views.filter_notices(notices, today(), hidden=("5-LOW",), scope="competition", days=365, query="7")
    return views.filter_notices(found, today(), scope="deadline").select("o_orderkey")


@query(
    "WITH n AS (SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderstatus <> 'P' AS has FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC, has DESC, CAST(o_orderkey AS VARCHAR)) AS turn FROM n) "
    "SELECT o_orderkey, turn, CASE WHEN has THEN 'deadline ' || CAST(month(CAST(d AS DATE)) AS VARCHAR) || '月' || CAST(day(CAST(d AS DATE)) AS VARCHAR) || '日' ELSE '' END AS dates FROM r WHERE turn <= 5"
)
def q80_compact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("url", F.col("o_orderkey").cast("string"))
    has = F.col("o_orderstatus") != "P"
    notices = orders.select(F.col("o_custkey").alias("competition"), "url", F.lit("t").alias("title"), day().alias("date"), F.lit(None).cast("string").alias("group_url"), F.when(has, day()).alias("deadline"))
    slots = orders.filter(has).select("url", F.lit("deadline").alias("kind"), day().alias("value"), F.lit("confirmed").alias("state"))
    made = views.compact_rows(notices, slots, 5)
    return made.select(F.col("url").cast("long").alias("o_orderkey"), F.col("turn").cast("long").alias("turn"), "dates")


@query(
    f"SELECT o_orderkey, CASE WHEN n < 0 THEN '未来' WHEN n = 0 THEN '今天' WHEN n = 1 THEN '昨天' WHEN n < 30 THEN n || ' 天前' WHEN n < 365 THEN n // 30 || ' 个月前' ELSE n // 365 || ' 年前' END AS ago, month(d) || '月' || day(d) || '日' AS label, n <= 90 AS fresh, "
    "strftime(make_date(1998 + CAST(month(d) < 8 AS INT), month(d), 1), '%Y-%m-%d') AS first, strftime(make_date(1998 + CAST(month(d) < 8 AS INT), month(d), 15), '%Y-%m-%d') AS behind "
    f"FROM (SELECT o_orderkey, o_orderdate AS d, CAST(date_diff('day', o_orderdate, TIMESTAMP '{NOW}') AS BIGINT) AS n FROM orders)"
)
def q81_day_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "orders").withColumn("day", day()).withColumn("window", dates.next_window(F.month("o_orderdate"), today()))
    age = dates.days_since(F.col("day"), today())
    return made.select("o_orderkey", dates.ago_text(age).alias("ago"), dates.deadline_text(F.col("day")).alias("label"), dates.is_fresh(F.col("day"), today()).alias("fresh"), F.date_format("window.first", "yyyy-MM-dd").alias("first"), F.date_format("window.behind", "yyyy-MM-dd").alias("behind"))


@query(
    "SELECT o_orderkey, CAST(year(o_orderdate) AS DOUBLE) AS year, CAST(month(o_orderdate) AS DOUBLE) AS edition, CASE o_orderstatus WHEN 'O' THEN 'campus' WHEN 'F' THEN 'national' ELSE 'semifinal' END AS phase, CASE o_orderstatus WHEN 'O' THEN '决赛' WHEN 'F' THEN '第2轮' END AS stage, "
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'postponement' WHEN '2-HIGH' THEN 'results' ELSE 'registration' END AS notice_type, o_orderpriority = '5-LOW' AS ambiguous FROM (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate + INTERVAL 10 YEAR END AS o_orderdate, o_orderstatus, o_orderpriority FROM orders) WHERE o_orderpriority <> '5-LOW' "
    "UNION ALL SELECT o_orderkey, NULL, CAST(month(o_orderdate) AS DOUBLE), CASE o_orderstatus WHEN 'O' THEN 'campus' WHEN 'F' THEN 'national' ELSE 'semifinal' END, CASE o_orderstatus WHEN 'O' THEN '决赛' WHEN 'F' THEN '第2轮' END, 'registration', true FROM orders WHERE o_orderpriority = '5-LOW'"
)
def q82_title_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that state year, edition (in Chinese numbers), phase, stage and type; urgent ones are postponed."""
    numbers = F.array(*[F.lit(x) for x in "一 二 三 四 五 六 七 八 九 十 十一 十二".split()])
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "报名延期").when(F.col("o_orderpriority") == "2-HIGH", "获奖名单").when(F.col("o_orderpriority") == "5-LOW", "2001年报名").otherwise("报名")
    phase = F.when(F.col("o_orderstatus") == "O", "校内决赛").when(F.col("o_orderstatus") == "F", "全国赛第二轮").otherwise("复赛")
    title = F.concat((F.year("o_orderdate") + 10).cast("string"), F.lit("年第"), F.element_at(numbers, F.month("o_orderdate")), F.lit("届竞赛"), phase, kind)
    made = table(spark, sf_dir, "orders").select("o_orderkey", editions.identity(title).alias("i"))
    return made.select("o_orderkey", *[F.col(f"i.{c}").cast("double").alias(c) for c in ("year", "edition")], "i.phase", "i.stage", "i.notice_type", "i.ambiguous")


@query(
    "SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'O' THEN y WHEN 'F' THEN NULL ELSE 2020 END AS DOUBLE) AS year, CAST(CASE o_orderstatus WHEN 'F' THEN NULL ELSE 12 END AS DOUBLE) AS edition, o_orderstatus = 'F' AS ambiguous, CASE o_orderstatus WHEN 'F' THEN 'year,edition' ELSE '' END AS conflicts, CASE WHEN o_orderstatus = 'P' THEN 'title' ELSE 'title_body' END AS method "
    "FROM (SELECT *, 2000 + month(o_orderdate) AS y FROM orders)"
)
def q83_refined_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The body names the edition (O), another one than the title (F), or only earlier ones (P)."""
    year = (F.month("o_orderdate") + 2000).cast("string")
    title = F.when(F.col("o_orderstatus") == "O", "关于机器人设计大赛的通知").otherwise("2020年第十二届机器人设计大赛通知")
    body = F.when(F.col("o_orderstatus") == "P", "往届回顾：上届2010年第九届机器人设计大赛已经结束。").otherwise(F.concat(F.lit("各学院：\n"), year, F.lit("年第"), F.when(F.col("o_orderstatus") == "O", "十二").otherwise("三"), F.lit("届机器人设计大赛开始报名。")))
    docs = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")).select("o_orderkey", title.alias("title"), body.alias("body"), F.array(F.lit("机器人设计大赛")).alias("names"))
    made = editions.refined_identity(docs, "title", "body", "names")
    return made.select("o_orderkey", F.col("identity.year").cast("double").alias("year"), F.col("identity.edition").cast("double").alias("edition"), "identity.ambiguous", F.array_join("identity.conflicts", ",").alias("conflicts"), "identity.method")


@query(
    "WITH r AS (SELECT l_orderkey AS notice, l_partkey AS url, l_linenumber AS id FROM lineitem WHERE l_linestatus = 'O'), a AS (SELECT l_orderkey AS notice, l_partkey AS url FROM lineitem WHERE l_returnflag = 'A'), k AS (SELECT DISTINCT r.* FROM r SEMI JOIN a ON a.notice = r.notice AND a.url = r.url) "
    "SELECT o_orderkey, CAST(count(k.notice) AS BIGINT) AS resources, count(k.notice) > 0 AS rehashed FROM orders LEFT JOIN k ON k.notice = o_orderkey GROUP BY 1"
)
def q84_with_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    listed = items.filter("l_returnflag = 'A'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set(F.col("l_partkey").cast("string")).alias("attachments"))
    records = table(spark, sf_dir, "orders").select("o_orderkey").join(listed, "o_orderkey", "left").withColumns({"url": F.col("o_orderkey").cast("string"), "content_hash": F.lit("h"), "images": F.lit(None).cast("array<string>")})
    none = F.lit(None).cast("string")
    resources = items.filter("l_linestatus = 'O'").select(F.col("l_linenumber").cast("string").alias("id"), F.col("l_orderkey").cast("string").alias("notice_url"), F.col("l_partkey").cast("string").alias("url"), none.alias("sha256"), none.alias("status"), none.alias("parser_version"), none.alias("text")).distinct()
    made = assembly.with_resources(records, resources)
    return made.select("o_orderkey", F.coalesce(F.size("resources"), F.lit(0)).cast("long").alias("resources"), (F.col("content_hash") != F.col("body_hash")).alias("rehashed")).withColumn("resources", F.greatest("resources", F.lit(0)))


@query(
    "SELECT c_custkey, regexp_replace(c_name, '[\\s]', '', 'g') AS identity, lower(regexp_replace(c_name || '（A—b）', '[\\s“”\"（）()·—-]', '', 'g')) AS classifier, 'https://a.edu.cn/x' || c_custkey AS url, c_mktsegment AS category, '第' || c_custkey || '届' AS label FROM customer"
)
def q85_text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.identity_key(F.concat(F.lit(" “"), F.col("c_name"), F.lit("” "))).alias("identity"), text.classifier_key(F.concat("c_name", F.lit("（A—b）"))).alias("classifier"), text.mended_url(F.concat(F.lit("https：/a·edu/cn /x"), k)).alias("url"),
        assembly.clean_category(F.concat(F.lit(" ·1. "), F.col("c_mktsegment")), "other").alias("category"), F.concat(F.lit("第"), editions.round_number(k).cast("string"), F.lit("届")).alias("label"),
    )


@query(
    "SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN 'deadline' WHEN contains(p_name, 'bolt') THEN 'contacts,groups' ELSE 'deadline,audiences,registrationMethods,registrationLinks,requiredMaterials,contacts,groups' END AS topics FROM part"
)
def q86_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.concat("p_name", F.when(F.contains("p_name", F.lit("ring")), "时间安排").when(F.contains("p_name", F.lit("bolt")), "联系 qq群").otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(diagnosis.topics(c), ",").alias("topics"))


@query(
    "WITH c AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1) SELECT c_mktsegment, n, CASE c_mktsegment WHEN 'FURNITURE' THEN 0 WHEN 'MACHINERY' THEN 1 ELSE 2 END AS position FROM c"
)
def q87_counted_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.counted(table(spark, sf_dir, "customer"), "c_mktsegment", ["FURNITURE", "MACHINERY"])


@query(SORTED_SQL + " SELECT count(*) AS total, count_if(deadline IS NOT NULL)::BIGINT AS recruiting, count_if(score >= 4)::BIGINT AS core, count_if(notices > 0)::BIGINT AS with_notices, count_if(number IS NOT NULL)::BIGINT AS with_window FROM c")
def q88_header_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.header_stats(competitions_of(spark, sf_dir).withColumn("window_start", F.col("number")))


@query(
    "SELECT o_orderkey, 'registration_start' AS first_kind, strftime(d, '%Y-%m-%d') AS first_day, CASE o_orderstatus WHEN 'O' THEN 'campus_deadline' ELSE 'registration_deadline' END AS second_kind, strftime(d + INTERVAL 40 DAY, '%Y-%m-%d') AS second_day, CASE WHEN year(d + INTERVAL 40 DAY) > year(d) THEN 'cross_year' ELSE '' END AS flags, '17:30' AS time "
    "FROM (SELECT o_orderkey, o_orderstatus, o_orderdate + INTERVAL 20 YEAR AS d FROM orders)"
)
def q89_registration_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of registration is a start and a deadline; the year goes on where the range passes the new year."""
    first = F.col("o_orderdate") + F.make_ym_interval(F.lit(20))
    second = first + F.make_dt_interval(F.lit(40))
    written = F.concat(F.lit("安排如下。"), F.when(F.col("o_orderstatus") == "O", "校内").otherwise(""), F.lit("报名时间："), F.date_format(first, "yyyy年M月d日"), F.lit("至"), F.date_format(second, "M月d日"), F.lit("下午5点半。比赛另行安排"))
    made = facts.date_events(spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")).select("o_orderkey", written.alias("written"), F.date_format(first, "yyyy-MM-dd").alias("day")), "written", "day", "e")
    return made.select("o_orderkey", *[F.col("e")[i][m].alias(f"{n}_{x}") for i, n in enumerate(("first", "second")) for m, x in (("kind", "kind"), ("value", "day"))], F.array_join(F.col("e")[1]["flags"], ",").alias("flags"), F.col("e")[1]["time"].alias("time"))


@query(
    "SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS sources, count(*) AS n, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events GROUP BY user_id, k"
)
def q90_same_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return views.same_entries(e, ["user_id"], ["k"], "event_type").select("user_id", F.array_join("sources", ",").alias("sources"), "n", "k")


@query(
    "WITH c AS (SELECT c_custkey AS k, '138' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS p, c_acctbal < 2000 AS joint FROM customer) SELECT k AS c_custkey, '王明' AS name, p AS phone, '' AS flags FROM c WHERE NOT joint "
    "UNION ALL SELECT k, '李华', '', '' FROM c WHERE joint UNION ALL SELECT k, '张强', '', '' FROM c WHERE joint UNION ALL SELECT k, '', p, 'relationship_ambiguous' FROM c WHERE joint"
)
def q91_contact_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named person has the number next to the name; two names that share one have none."""
    number = F.concat(F.lit("138"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"))
    body = F.when(F.col("c_acctbal") < 2000, F.concat(F.lit("三、联系方式\n联系人：李华、张强，"), number)).otherwise(F.concat(F.lit("三、联系方式\n联系人：王明，电话"), number))
    docs = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("url"), F.lit("").alias("title"), body.alias("body"))
    found = extraction.contact_facts(extraction.sentences(docs))
    value = lambda field: F.coalesce(F.max(F.when(F.col("field") == f"contacts.{field}", F.col("value"))), F.lit(""))
    people = found.groupBy("url", "item").agg(value("name").alias("name"), value("phones").alias("phone"), F.array_join(F.array_distinct(F.flatten(F.collect_list("flags"))), ",").alias("flags"))
    return people.select(F.col("url").cast("long").alias("c_custkey"), "name", "phone", "flags")


@query(
    "SELECT c_custkey, 'https://a.example/form/' || c_custkey AS link, CASE WHEN c_acctbal < 2000 THEN 'scope_ambiguous' ELSE '' END AS flags FROM customer"
)
def q92_registration_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An address in sentences of two tracks is ambiguous; a homepage is no entry."""
    link = F.concat(F.lit("https://a.example/form/"), F.col("c_custkey").cast("string"))
    body = F.concat(F.lit("网上填写 "), link, F.lit("\n主页 https://b.example/\n"), F.when(F.col("c_acctbal") < 2000, F.concat(F.lit("水下赛道：\n填写 "), link)).otherwise(""))
    docs = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("url"), F.lit("").alias("title"), body.alias("body"))
    found = extraction.link_facts(extraction.sentences(docs))
    return found.select(F.col("url").cast("long").alias("c_custkey"), F.col("value").alias("link"), F.array_join("flags", ",").alias("flags"))


@query(
    "WITH o AS (SELECT o_orderkey, o_orderstatus AS s, o_orderdate + INTERVAL 20 YEAR AS d FROM orders), x AS (SELECT o_orderkey, s, strftime(d + INTERVAL 10 DAY, '%Y-%m-%d') AS first, strftime(d + INTERVAL 30 DAY, '%Y-%m-%d') AS later FROM o) "
    "SELECT o_orderkey, CASE s WHEN 'F' THEN later ELSE first || ',' || later END AS entries, CASE s WHEN 'F' THEN first ELSE '' END AS history, CAST(CASE s WHEN 'F' THEN 1 ELSE 0 END AS BIGINT) AS applied, CAST(CASE s WHEN 'P' THEN 1 ELSE 0 END AS BIGINT) AS pending, CASE s WHEN 'F' THEN 'confirmed' WHEN 'P' THEN 'needs_review' ELSE 'conflict' END AS state FROM x"
)
def q93_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deadline, and a later notice of another: moved by it (F), moved on the same day, which waits for review (P), or
    only told otherwise, which is a conflict (O)."""
    day = F.col("o_orderdate") + F.make_ym_interval(F.lit(20))
    plus = lambda n, form: F.date_format(day + F.make_dt_interval(F.lit(n)), form)
    base = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")).withColumn("k", F.col("o_orderkey").cast("string"))
    second = F.concat(F.lit("报名截止"), F.when(F.col("o_orderstatus") == "O", "").otherwise("时间调整为"), plus(30, "yyyy年M月d日"))
    first = base.select("o_orderkey", F.concat("k", F.lit(":1")).alias("url"), "k", plus(0, "yyyy-MM-dd").alias("date"), F.concat(F.lit("报名截止"), plus(10, "yyyy年M月d日")).alias("body"))
    later = base.select("o_orderkey", F.concat("k", F.lit(":2")).alias("url"), "k", F.when(F.col("o_orderstatus") == "P", plus(0, "yyyy-MM-dd")).otherwise(plus(5, "yyyy-MM-dd")).alias("date"), second.alias("body"))
    docs = first.unionByName(later)
    none = F.lit(None).cast("string")
    notices_ = docs.select("url", "date", F.col("k").alias("competition"), F.col("k").alias("edition_id"), none.alias("phase"), none.alias("stage"))
    made = editions.slots(notices_, notices.events(docs, "url", "body", "date"))
    values = lambda c: F.array_join(F.array_sort(F.transform(c, lambda e: e["value"])), ",")
    return made.select(F.col("competition").cast("long").alias("o_orderkey"), values("entries").alias("entries"), values("history").alias("history"), "applied", "pending", "state")
