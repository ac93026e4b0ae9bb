"""The queries over the driver tables by name: a DataFrame program, and SQL that it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.functions import dates, facts, html, text
from tidewell.operators import cadence, calendar, history, layout, linking, merging, reports

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
NOW = "1998-08-01"
TAXONOMY = [("ring", ["ring", "band"]), ("tool", ["widget", "gadget", "gizmo"]), ("part", ["bolt", "gear", "cog"])]
KEYWORDS = ["the", "license", "und der"]
NAMES = ["red widget", "small ring", "widget", "ring", "bolt", "gear", "red", "blue"]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A small table dealt out over all cores, for work that costs far more than moving its rows; a large one as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


WINDOW_SQL = """
WITH o AS (SELECT o_custkey, year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders),
k AS (SELECT o_custkey, count(DISTINCT y) AS years, count(*) AS total FROM o GROUP BY 1 HAVING count(DISTINCT y) >= 2),
c AS (SELECT o_custkey, m, count(*) AS n FROM o GROUP BY 1, 2),
w AS (SELECT s.s AS start, l.l AS size FROM (SELECT unnest(range(1, 13)) AS s) s, (SELECT unnest(range(1, 7)) AS l) l),
t AS (SELECT k.o_custkey, k.years, k.total, w.start, w.size, sum(CASE WHEN (c.m - w.start + 12) % 12 < w.size THEN c.n ELSE 0 END) AS covered
  FROM k JOIN c USING (o_custkey) CROSS JOIN w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY size, covered DESC, start DESC) AS rn FROM t WHERE covered * 100 >= total * 60)
SELECT o_custkey, CAST(years AS BIGINT) AS years_observed, CAST(total AS BIGINT) AS total, CAST(start AS BIGINT) AS window_start,
  CAST((start + size - 2) % 12 + 1 AS BIGINT) AS window_end, CAST(covered AS BIGINT) AS covered, CAST(floor(covered * 100 / total) AS BIGINT) AS percent,
  CASE WHEN years >= 4 THEN 'high' WHEN years >= 3 THEN 'medium' ELSE 'low' END AS confidence FROM r WHERE rn = 1
"""


@query(WINDOW_SQL)
def q01_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cadence.cadence(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


@query("SELECT o_custkey, CAST(month(o_orderdate) AS BIGINT) AS month, CAST(count(DISTINCT year(o_orderdate)) AS BIGINT) AS years FROM orders GROUP BY 1, 2 HAVING count(DISTINCT year(o_orderdate)) >= 2")
def q02_stable_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cadence.stable_months(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


HISTOGRAM = "SELECT CAST(m.m AS BIGINT) AS month, CAST(count(o.o_orderkey) AS BIGINT) AS n FROM (SELECT unnest(range(1, 13)) AS m) m LEFT JOIN orders o ON month(o.o_orderdate) = m.m GROUP BY 1"


@query(HISTOGRAM)
def q03_month_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cadence.month_histogram(table(spark, sf_dir, "orders"), "o_orderdate")


@query(f"WITH h AS ({HISTOGRAM}) SELECT month, n FROM h WHERE n * 100 >= (SELECT max(n) FROM h) * 60")
def q04_peak_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cadence.peak_months(table(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "WITH d AS (SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC) AS rn FROM d) "
    "SELECT o_custkey, string_agg(d, ',' ORDER BY d DESC) AS evidence FROM r WHERE rn <= 8 GROUP BY 1"
)
def q05_recent_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cadence.evidence(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


@query(
    "SELECT p_partkey, CASE WHEN contains(p_name, 'ring') OR contains(p_name, 'band') THEN 'ring' WHEN contains(p_name, 'widget') OR contains(p_name, 'gadget') OR contains(p_name, 'gizmo') THEN 'tool' "
    "WHEN contains(p_name, 'bolt') OR contains(p_name, 'gear') OR contains(p_name, 'cog') THEN 'part' ELSE 'other' END AS category FROM part"
)
def q06_classify_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.classify(F.col("p_name"), TAXONOMY, "other").alias("category"))


@query("SELECT doc_id, coalesce(contains(text, 'the') OR contains(text, 'license') OR contains(text, 'und der'), false) AS flagged FROM documents")
def q07_keyword_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.contains_any(F.col("text"), KEYWORDS).alias("flagged"))


@query("SELECT p_partkey, p_type FROM part WHERE regexp_matches(p_type, '^(ECONOMY|PROMO|SMALL)') AND NOT regexp_matches(p_type, 'MO$')")
def q08_allow_deny(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(text.allow_deny(F.col("p_type"), "^(ECONOMY|PROMO|SMALL)", "MO$")).select("p_partkey", "p_type")


@query("SELECT c_custkey, regexp_replace(lower(c_name), '[^a-z0-9#]', '', 'g') AS name_key FROM customer")
def q09_normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", text.normal_name(F.col("c_name")).alias("name_key"))


@query(f"SELECT doc_id, translate(translate(text, '{text.FULL}', '{text.HALF.replace(chr(39), chr(39) * 2)}'), '　', ' ') AS head FROM documents")
def q10_fullwidth_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.half_width(F.col("text")).alias("head"))


@query("SELECT p_partkey, p_name FROM part WHERE contains(regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g'), 'redwidget')")
def q11_search_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(text.match_score(F.col("p_name"), F.lit("Red-Widget!")) == 2).select("p_partkey", "p_name")


@query("SELECT p_partkey, CASE WHEN contains(replace(p_name, ' ', ''), 'rdg') THEN 2 WHEN p_name LIKE '%r%d%g%' THEN 1 ELSE 0 END AS score FROM part")
def q12_search_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.match_score(F.col("p_name"), F.lit("rdg")).alias("score"))


@query(
    "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal >= 1000 AND contains(lower(c_name), '1') "
    "AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1999-01-01')"
)
def q13_faceted_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    facets = {"segment": F.col("c_mktsegment") == "BUILDING", "balance": F.col("c_acctbal") >= 1000, "nation": None, "text": F.contains(text.haystack(F.col("c_name")), F.lit("1"))}
    found = reports.facet_filter(table(spark, sf_dir, "customer"), facets)
    recent = table(spark, sf_dir, "orders").filter("o_orderdate >= timestamp_ntz '1999-01-01'").select("o_custkey")
    return found.join(recent, found.c_custkey == recent.o_custkey, "left_semi").select("c_custkey", "c_name")


@query("SELECT CAST(row_number() OVER (ORDER BY p_retailprice DESC, p_name, p_partkey) AS BIGINT) AS rank, p_partkey, p_retailprice FROM part QUALIFY rank <= 30")
def q14_catalog_sort_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The cap comes first, so that the rank is numbered over 30 rows.
    top = table(spark, sf_dir, "part").orderBy(F.desc("p_retailprice"), "p_name", "p_partkey").limit(30)
    return top.select(F.row_number().over(Window.orderBy(F.desc("p_retailprice"), "p_name", "p_partkey")).cast("long").alias("rank"), "p_partkey", "p_retailprice")


@query(
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_orderdate DESC, o_orderkey) = 1 AS heading FROM orders"
)
def q15_group_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.group_by_month(table(spark, sf_dir, "orders"), "o_orderdate", [-F.unix_micros(F.col("o_orderdate").cast("timestamp")), F.col("o_orderkey")]).select("o_orderkey", "month", "heading")


@query("SELECT o_orderkey FROM orders WHERE month(o_orderdate) >= 11 OR month(o_orderdate) <= 2")
def q16_circular_month_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(dates.in_window(F.month("o_orderdate"), F.lit(11), F.lit(2))).select("o_orderkey")


@query(
    "WITH h AS (SELECT doc_id, text, substr(text, 1, 480) AS h FROM documents), p AS (SELECT *, length(h) - strpos(reverse(h), '.') + 1 AS cut_at FROM h) "
    "SELECT doc_id, CASE WHEN length(text) <= 480 THEN text WHEN contains(h, '.') AND cut_at >= 264 THEN substr(h, 1, cut_at) ELSE h || '…' END AS cut, "
    "CASE WHEN length(text) > 480 THEN h || '…' ELSE text END AS head FROM p"
)
def q17_excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", text.excerpt(c, marks=(".",)).alias("cut"), text.head_excerpt(c).alias("head"))


@query("SELECT count(*) AS n, count_if(o_orderstatus = 'F')::BIGINT AS finished, count(DISTINCT o_custkey) AS customers, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day FROM orders")
def q18_global_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.count_distinct("o_custkey").alias("customers"), F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"))


@query(
    "SELECT 'lang' AS facet, coalesce(lang, '?') AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'source', coalesce(source, '?'), count(*) FROM documents GROUP BY 2 "
    "UNION ALL SELECT 'long', CAST(n_chars > 2000 AS VARCHAR), count(*) FROM documents GROUP BY 2"
)
def q19_counts_by_facet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.facet_counts(table(spark, sf_dir, "documents"), {"lang": F.col("lang"), "source": F.col("source"), "long": F.col("n_chars") > 2000})


@query(
    "WITH o AS (SELECT event_id, event_type, value FROM events WHERE event_id % 3 <> 0), n AS (SELECT event_id, event_type, value * 2 AS value, user_id FROM events WHERE event_id % 2 = 0) "
    "SELECT coalesce(o.event_id, n.event_id) AS event_id, coalesce(n.event_type, o.event_type) AS event_type, coalesce(n.value, o.value) AS value, CAST(n.user_id AS DOUBLE) AS user_id FROM o FULL JOIN n ON o.event_id = n.event_id"
)
def q20_upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    new = e.filter("event_id % 2 = 0").select("event_id", "event_type", (F.col("value") * 2).alias("value"), F.col("user_id").cast("double").alias("user_id"))
    return merging.upsert(e.filter("event_id % 3 <> 0").select("event_id", "event_type", "value"), new, "event_id")


@query("SELECT event_id, event_type FROM events WHERE event_id % 3 = 0 UNION ALL SELECT event_id, 'late' FROM events WHERE event_id % 2 = 0 AND event_id % 3 <> 0")
def q21_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    return merging.insert_if_absent(e.filter("event_id % 3 = 0"), e.filter("event_id % 2 = 0").withColumn("event_type", F.lit("late")), ["event_id"])


@query("SELECT min(doc_id) AS doc_id FROM documents GROUP BY regexp_replace(lower(text), '[^a-zà-ÿ0-9]', '', 'g')")
def q22_first_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.sha2(F.regexp_replace(F.lower("text"), "[^a-zà-ÿ0-9]", "").cast("binary"), 256)
    return merging.first_by(table(spark, sf_dir, "documents").select("doc_id", key.alias("key")), [F.col("key")], [F.col("doc_id")]).select("doc_id")


@query("SELECT p_partkey, CASE WHEN row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) > 1 THEN p_name || ' (' || p_brand || ')' ELSE p_name END AS p_name FROM part")
def q23_disambiguate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.disambiguate(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), "p_name", F.col("p_brand"), [F.col("p_partkey")]).select("p_partkey", "p_name")


@query(
    "WITH u AS (SELECT c_name AS name, 0 AS p, 'customer' AS origin FROM customer UNION ALL SELECT 'customer ' || substr(s_name, 10), 1, 'supplier' FROM supplier UNION ALL SELECT n_name, 2, 'nation' FROM nation), "
    "k AS (SELECT *, regexp_replace(lower(name), '[^a-z0-9#]', '', 'g') AS name_key FROM u), r AS (SELECT *, row_number() OVER (PARTITION BY name_key ORDER BY p, name) AS rn FROM k) SELECT name_key, name, origin FROM r WHERE rn = 1"
)
def q24_priority_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.lit("customer").alias("origin"))
    suppliers = table(spark, sf_dir, "supplier").select(F.concat(F.lit("customer "), F.substring("s_name", 10, 100)).alias("name"), F.lit("supplier").alias("origin"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.lit("nation").alias("origin"))
    parts = [p.withColumn("name_key", text.normal_name(F.col("name"))) for p in (customers, suppliers, nations)]
    return merging.priority_union(parts, F.col("name_key"), [F.col("name")]).select("name_key", "name", "origin")


@query("SELECT n_nationkey, CASE n_nationkey WHEN 1 THEN 'First' WHEN 3 THEN 'Third' ELSE n_name END AS n_name, CASE n_nationkey WHEN 3 THEN 0 ELSE n_regionkey END AS n_regionkey FROM nation")
def q25_override_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixes = spark.createDataFrame([(1, "First", None), (3, "Third", 0)], "n_nationkey int, n_name string, n_regionkey int")
    return merging.override(table(spark, sf_dir, "nation"), fixes, "n_nationkey")


@query(
    "SELECT CAST(n.n_nationkey AS DOUBLE) AS n_nationkey, n.n_name, CAST(min(s.s_suppkey) AS DOUBLE) AS supplier, CASE WHEN min(s.s_suppkey) IS NULL THEN 'nation only' ELSE 'both' END AS origin FROM nation n LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey AND s.s_acctbal > 5000 GROUP BY 1, 2 "
    "UNION ALL SELECT NULL, s_name, CAST(s_suppkey AS DOUBLE), 'supplier only' FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)"
)
def q26_dimension_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, supplier = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    rich = supplier.filter("s_acctbal > 5000").groupBy("s_nationkey").agg(F.min("s_suppkey").alias("supplier"))
    both = nation.join(rich, nation.n_nationkey == rich.s_nationkey, "left").select(F.col("n_nationkey").cast("double").alias("n_nationkey"), "n_name", F.col("supplier").cast("double").alias("supplier"), F.when(F.col("supplier").isNull(), "nation only").otherwise("both").alias("origin"))
    near = nation.filter("n_regionkey < 3")
    rest = supplier.join(near, supplier.s_nationkey == near.n_nationkey, "left_anti").select(F.lit(None).cast("double").alias("n_nationkey"), F.col("s_name").alias("n_name"), F.col("s_suppkey").cast("double").alias("supplier"), F.lit("supplier only").alias("origin"))
    return both.unionByName(rest)


@query(
    "SELECT p_partkey, CASE WHEN contains(p_name, 'red widget') THEN 'red widget' WHEN contains(p_name, 'small ring') THEN 'small ring' WHEN contains(p_name, 'widget') THEN 'widget' WHEN contains(p_name, 'ring') THEN 'ring' "
    "WHEN contains(p_name, 'bolt') THEN 'bolt' WHEN contains(p_name, 'gear') THEN 'gear' WHEN contains(p_name, 'blue') THEN 'blue' WHEN contains(p_name, 'red') THEN 'red' END AS linked FROM part"
)
def q27_entity_link_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linking.link_longest(table(spark, sf_dir, "part"), "p_name", [(n, n) for n in NAMES], "linked").select("p_partkey", "linked")


@query(
    "SELECT p_partkey, CASE contains(p_name, 'red')::INT + contains(p_name, 'ring')::INT + contains(p_name, 'widget')::INT WHEN 0 THEN 'unmatched' WHEN 1 THEN CASE WHEN contains(p_name, 'red') THEN 'red' WHEN contains(p_name, 'ring') THEN 'ring' ELSE 'widget' END ELSE 'ambiguous' END AS linked FROM part"
)
def q28_entity_link_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linking.link_unique(table(spark, sf_dir, "part"), "p_name", ["red", "ring", "widget"], "linked").select("p_partkey", "linked")


@query("SELECT doc_id, item_id FROM documents, benchmark WHERE contains(documents.text, benchmark.text)")
def q29_passage_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("passage"))
    return linking.contained_passages(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text", passages, "passage").select("doc_id", "item_id")


@query("SELECT page_id, regexp_replace(regexp_replace(lower(trim(url)), '^https?://(www\\.)?', ''), '/+$', '') AS url_key FROM pages")
def q30_url_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.url_key(F.col("url")).alias("url_key"))


@query(
    "SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '[?&]page=([0-9]+)', 1) AS page FROM pages"
)
def q31_url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", *[text.url_part(c, p).alias(p) for p in ("scheme", "host", "path")], F.regexp_extract(c, "[?&]page=([0-9]+)", 1).alias("page"))


@query("WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS href FROM pages), c AS (SELECT href, count(DISTINCT page_id) AS pages FROM l GROUP BY 1) SELECT href, pages FROM c WHERE pages <= 40")
def q32_html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(text.hrefs(F.col("html"))).alias("href"))
    return links.groupBy("href").agg(F.count_distinct("page_id").alias("pages")).filter("pages <= 40")


@query()
def q33_html_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = html.articles(table(spark, sf_dir, "pages"), "page_id", "html")
    return made.select("page_id", "title", *[F.size(c).cast("long").alias(c) for c in ("headings", "paragraphs", "links", "images")], "tables", "content_hash")


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def q34_html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.html_title(F.col("html")).alias("title"))


@query(
    "WITH s AS (SELECT doc_id, unnest(string_split_regex(text, '[。；;.\n]')) AS s FROM documents), t AS (SELECT doc_id, trim(s) AS s FROM s WHERE trim(s) <> '') SELECT doc_id, count(*) AS sentences, CAST(sum(length(s)) AS BIGINT) AS chars FROM t GROUP BY 1"
)
def q35_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "documents").select("doc_id", text.sentences(F.col("text")).alias("s")).filter(F.size("s") > 0)
    return made.select("doc_id", F.size("s").cast("long").alias("sentences"), F.aggregate("s", F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("chars"))


# Marks around each run of digits stand for what is looked for beside it.
@query(
    "WITH c AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}') AS e, "
    "list_transform(regexp_extract_all(regexp_replace(text, '([0-9]+)', '\x01\\1\x02', 'g'), '(?:\\+?\x0186\x02[- ])?\x011[0-9]{10}\x02|\\+?\x01861[0-9]{10}\x02|\x010[0-9]{2,3}\x02[- ]\x01[0-9]{7,8}\x02|\x010[0-9]{9,11}\x02'), lambda x: replace(replace(x, '\x01', ''), '\x02', '')) AS p FROM documents) "
    "SELECT doc_id, array_to_string(e, ',') AS emails, array_to_string(list_filter(p, lambda x, i: list_position(p, x) = i), ',') AS phones FROM c WHERE len(e) > 0 OR len(p) > 0"
)
def q36_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.struct(F.array_join(text.emails(F.col("text")), ",").alias("emails"), F.array_join(text.phones(F.col("text")), ",").alias("phones"))
    # Generated, so that the filter doesn't look for everything again.
    return table(spark, sf_dir, "documents").select("doc_id", F.inline(F.array(found))).filter("emails <> '' or phones <> ''")


@query(
    "SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS full_date, strftime(d, '%Y-%m-%d') AS first_event, CAST(length(CAST(o_orderkey AS VARCHAR)) + 5 AS BIGINT) AS start FROM (SELECT o_orderkey, o_orderdate + INTERVAL 20 YEAR AS d FROM orders)"
)
def q37_date_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.concat(F.lit("No. "), F.col("o_orderkey").cast("string"), F.lit(":"), F.date_format(F.col("o_orderdate") + F.make_ym_interval(F.lit(20)), "yyyy年M月d日"), F.lit(" and 2026年2月30日"))
    made = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")).withColumn("written", written)
    made = facts.date_events(made.withColumn("published", F.lit("1990-01-01")), "written", "published", "events")
    made = made.select("o_orderkey", dates.dates_in(F.col("written"))[0].alias("full_date"), F.col("events")[0].alias("e"))
    return made.select("o_orderkey", "full_date", F.col("e.value").alias("first_event"), F.col("e.start").cast("long").alias("start"))


NOTE_SQL = "WITH n AS (SELECT o_orderkey, CAST(month(o_orderdate) AS VARCHAR) || '月' || CAST(day(o_orderdate) AS VARCHAR) || '日' AS d, CAST(o_orderkey AS VARCHAR) AS k FROM orders)"


@query(
    NOTE_SQL + ", e AS (SELECT o_orderkey, length(k) + 4 AS start, 5 + length(d) AS size, 'registration_start' AS kind FROM n UNION ALL SELECT o_orderkey, length(k) + 16 + length(d), length(d), 'registration_deadline' FROM n "
    "UNION ALL SELECT o_orderkey, length(k) + 22 + 2 * length(d), 5 + length(d), 'competition' FROM n) SELECT o_orderkey, kind, CAST(start AS BIGINT) AS start, CAST(start + size AS BIGINT) AS \"end\" FROM e"
)
def q38_evidence_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same day three times, once without its year: each fact keeps its own place and kind."""
    day = F.date_format("o_orderdate", "M月d日")
    written = F.concat(F.col("o_orderkey").cast("string"), F.lit("号报名自"), F.lit("2026年"), day, F.lit("开始，报名截至"), day, F.lit("结束；决赛 "), F.lit("2026年"), day, F.lit("。"))
    made = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")).select("o_orderkey", written.alias("written"), F.lit("2026-01-01").alias("published"))
    made = facts.date_events(made, "written", "published", "events").withColumn("e", F.explode("events"))
    again = F.substring(F.col("written"), F.col("e.start") + 1, F.col("e.end") - F.col("e.start"))
    return made.filter(again == F.col("e.raw")).select("o_orderkey", "e.kind", F.col("e.start").cast("long").alias("start"), F.col("e.end").cast("long").alias("end"))


@query("SELECT l_orderkey, CASE WHEN count(DISTINCT l_shipdate) = 1 THEN min(l_shipdate) END AS safe FROM lineitem GROUP BY 1")
def q39_safe_deadline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.safe_value(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_shipdate")


@query("SELECT o_custkey, o_orderpriority, count(*) AS n, count(DISTINCT o_orderstatus) AS values, count(DISTINCT o_orderstatus) > 1 AS conflict FROM orders GROUP BY 1, 2")
def q40_conflict_marking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.mark_conflicts(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], "o_orderstatus")


@query(
    "WITH l AS (SELECT event_id, user_id, event_type, ts, value, lag(value) OVER w AS previous FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)) "
    "SELECT event_id, previous, coalesce(previous <> value, false) AS changed, CAST(sum(coalesce(previous <> value, false)::INT) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS changes FROM l"
)
def q41_slot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.slot_history(table(spark, sf_dir, "events"), ["user_id", "event_type"], "value", ["ts", "event_id"]).select("event_id", "previous", "changed", "changes")


@query(
    f"WITH d AS (SELECT l_orderkey, max(l_shipdate) AS deadline FROM lineitem GROUP BY 1) SELECT o_orderkey, CASE WHEN o_orderdate > TIMESTAMP '{NOW}' THEN 'not_started' WHEN deadline < TIMESTAMP '{NOW}' THEN 'closed' ELSE 'open' END AS status FROM orders LEFT JOIN d ON l_orderkey = o_orderkey"
)
def q42_registration_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    last = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("deadline"))
    status = history.registration_status(F.col("o_orderdate"), F.col("deadline"), F.to_timestamp_ntz(F.lit(NOW)))
    return orders.join(last, orders.o_orderkey == last.l_orderkey, "left").select("o_orderkey", status.alias("status"))


@query(
    "WITH y AS (SELECT o_custkey, max(year(o_orderdate)) AS edition FROM orders GROUP BY 1), c AS (SELECT o.o_custkey, y.edition, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'P' THEN 'conflict' ELSE 'closed' END AS s FROM orders o JOIN y USING (o_custkey) WHERE year(o_orderdate) = y.edition) "
    "SELECT o_custkey, CAST(edition AS BIGINT) AS edition, count(*) AS parts, CASE WHEN bool_or(s = 'open') THEN 'open' WHEN bool_or(s = 'conflict') THEN 'conflict' ELSE 'closed' END AS state FROM c GROUP BY 1, 2"
)
def q43_current_edition(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "O", "open").when(F.col("o_orderstatus") == "P", "conflict").otherwise("closed")
    now = history.current_edition(table(spark, sf_dir, "orders").withColumn("s", state), "o_custkey", "o_orderdate")
    return now.groupBy("o_custkey", F.col("edition").cast("long").alias("edition")).agg(F.count("*").alias("parts"), history.roll_up(F.col("s")).alias("state"))


@query("SELECT count(*) AS total, CAST(count_if(l.doc_id IS NOT NULL) AS BIGINT) AS good, round(count_if(l.doc_id IS NOT NULL) / count(*), 4) AS rate FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id")
def q44_coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select(F.col("doc_id").alias("labelled")).distinct()
    return reports.coverage(docs.join(labels, docs.doc_id == labels.labelled, "left"), F.col("labelled").isNotNull())


REASONS = ["no_text", "too_short", "toxic", "low_quality", "unlabelled", "fine"]


@query(
    "WITH r AS (SELECT CASE WHEN coalesce(text, '') = '' THEN 'no_text' WHEN n_chars < 200 THEN 'too_short' WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'low_quality' WHEN l.doc_id IS NULL THEN 'unlabelled' ELSE 'fine' END AS reason FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id), "
    "k AS (SELECT unnest(['no_text', 'too_short', 'toxic', 'low_quality', 'unlabelled', 'fine']) AS reason) SELECT k.reason, count(r.reason) AS n FROM k LEFT JOIN r USING (reason) GROUP BY 1"
)
def q45_primary_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").withColumn("labelled", F.lit(True))
    joined = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    reason = reports.primary_reason(
        [("no_text", F.coalesce("text", F.lit("")) == ""), ("too_short", F.col("n_chars") < 200), ("toxic", F.col("toxic") == 1), ("low_quality", F.col("quality") == 0), ("unlabelled", F.col("labelled").isNull())], "fine"
    )
    return reports.zero_filled(joined.select(reason.alias("reason")), "reason", REASONS)


@query(
    "WITH d AS (SELECT doc_id, md5(regexp_replace(lower(text), '[^a-z]', '', 'g')) AS k, n_chars FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n_chars, doc_id) AS rn, count(*) OVER (PARTITION BY k) AS members FROM d) SELECT doc_id AS representative, members FROM r WHERE rn = 1"
)
def q46_display_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.display_groups(table(spark, sf_dir, "documents"), F.md5(F.regexp_replace(F.lower("text"), "[^a-z]", "").cast("binary")), "doc_id", [F.col("n_chars")])


@query(
    "WITH p AS (SELECT conv_id, turn, role, max(CASE WHEN role = 'user' THEN turn END) OVER w AS u, max(CASE WHEN role = 'assistant' THEN turn END) OVER w AS a FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) "
    "SELECT conv_id, turn, CAST(CASE role WHEN 'user' THEN a WHEN 'assistant' THEN u END AS DOUBLE) AS answers FROM p"
)
def q47_reference_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    for role in ("user", "assistant"):
        c = history.nearest_above(c, "conv_id", ["turn"], F.col("role") == role, "turn", f"last_{role}")
    return c.select("conv_id", "turn", F.when(F.col("role") == "user", F.col("last_assistant")).when(F.col("role") == "assistant", F.col("last_user")).cast("double").alias("answers"))


@query(
    "SELECT o_custkey, count(*) AS n, CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS open_orders, arg_max(o_orderkey, (o_orderdate, -o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY 1"
)
def q48_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = [F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "O").alias("open_orders")]
    return history.latest_per_key(table(spark, sf_dir, "orders"), "o_custkey", [F.col("o_orderdate"), -F.col("o_orderkey")], ["o_orderkey", "o_orderdate"], extra)


@query(
    "SELECT event_id, CAST(last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE) AS signup FROM events"
)
def q49_nearest_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.nearest_above(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "signup", "event_id", "signup").select("event_id", F.col("signup").cast("double").alias("signup"))


@query("SELECT e.event_id, CAST(max(s.event_id) AS DOUBLE) AS marked FROM events e LEFT JOIN events s ON s.event_type = 'error' AND s.event_id BETWEEN e.event_id - 6 AND e.event_id - 1 GROUP BY 1")
def q50_lookback_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.lookback(table(spark, sf_dir, "events"), "event_id", F.col("event_type") == "error", 6, "marked").select("event_id", F.col("marked").cast("double").alias("marked"))


@query(
    "WITH g AS (SELECT event_id, user_id, ts, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 3601000000, true)::INT AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) "
    "SELECT event_id, CAST(sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM g"
)
def q51_gap_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.gap_clusters(table(spark, sf_dir, "events"), "user_id", "ts", ["event_id"], 3600).select("event_id", "cluster")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS carried FROM events")
def q52_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("event_type") == "purchase", F.col("value"))
    return history.carry_forward(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], value, "carried").select("event_id", "carried")


@query(
    f"WITH c AS ({WINDOW_SQL}) SELECT o_custkey, 'BEGIN:VEVENT' || chr(13) || chr(10) || 'UID:h' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 12) || chr(13) || chr(10) || 'DTSTART;VALUE=DATE:1999' || lpad(CAST(window_start AS VARCHAR), 2, '0') || '01' || chr(13) || chr(10) "
    "|| 'RRULE:FREQ=YEARLY' || chr(13) || chr(10) || 'SUMMARY:Customer ' || o_custkey || '\\, ' || window_start || '-' || window_end || chr(13) || chr(10) || 'END:VEVENT' AS event FROM c"
)
def q53_calendar_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = q01_cadence(spark, sf_dir)
    start = F.concat(F.lit("1999"), F.lpad(F.col("window_start").cast("string"), 2, "0"), F.lit("01"))
    title = F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"), F.lit(", "), F.col("window_start").cast("string"), F.lit("-"), F.col("window_end").cast("string"))
    return made.select("o_custkey", calendar.event(calendar.stable_uid(F.col("o_custkey").cast("string")), start, title).alias("event"))


@query()
def q54_fold_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "documents").select("doc_id", layout.fold_lines(F.regexp_replace("text", r"\n", r"\\n")).alias("folded"))
    longest = F.array_max(F.transform(F.split("folded", "\r\n"), lambda x: F.octet_length(x)))
    return made.select("doc_id", F.octet_length("folded").alias("bytes"), longest.alias("longest"))


@query(
    "WITH v AS (SELECT o_custkey, o_orderkey, o_totalprice AS y, row_number() OVER w AS i, sum(o_totalprice) OVER w AS p, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)), "
    "a AS (SELECT o_custkey, i, p, abs(p / i - 50000) AS c FROM v), "
    "b AS (SELECT x.o_custkey, x.i AS i1, z.i AS i2, z.p AS p2, x.c AS c1, x.c + abs((z.p - x.p) / (z.i - x.i) - 200000) AS c2 FROM a x JOIN a z ON z.o_custkey = x.o_custkey AND z.i > x.i), "
    "t AS (SELECT o_custkey, p, n FROM v WHERE i = n AND n >= 3), "
    "r AS (SELECT b.o_custkey, i1, i2, row_number() OVER (PARTITION BY b.o_custkey ORDER BY c2 + abs((t.p - p2) / (n - i2) - 400000), i2, c2, i1) AS rn FROM b JOIN t ON t.o_custkey = b.o_custkey AND n > i2) "
    "SELECT v.o_custkey, v.o_orderkey, v.y AS o_totalprice, CAST(CASE WHEN n < 3 THEN i - 1 WHEN i <= i1 THEN 0 WHEN i <= i2 THEN 1 ELSE 2 END AS BIGINT) AS part FROM v LEFT JOIN r ON r.o_custkey = v.o_custkey AND rn = 1"
)
def q55_layout_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.partition_rows(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_totalprice", [50_000.0, 200_000.0, 400_000.0])


@query("SELECT conv_id, string_agg(role || ':' || length(text), '|' ORDER BY turn) AS turns FROM conversations GROUP BY 1")
def q56_ordered_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.struct("turn", F.concat("role", F.lit(":"), F.length("text").cast("string")).alias("said"))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(one)), lambda x: x["said"]), "|").alias("turns"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50")
def q57_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))
    return made.filter("k >= 50")


@query("SELECT doc_id, sha256(lower(trim(text))) AS sha, md5(lower(trim(text))) AS md5 FROM documents")
def q58_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    canonical = F.lower(F.trim("text")).cast("binary")
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(canonical, 256).alias("sha"), F.md5(canonical).alias("md5"))
