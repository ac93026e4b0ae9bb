import gzip
import zlib

from pyspark.sql import functions as F

from tidewell.operators import assembly, crawl, layout, merging, views
from tidewell.sources import lists

LIST = """<html><body><ul>
<li><a href="/info/1/11.htm" title="关于机器人竞赛报名的通知">x</a><span class="date">2026-03-01</span></li>
<li><a href="/info/1/12.htm">数学建模竞赛数学建模竞赛</a><i class="time">03-05 2026</i></li>
<li><a href="/info/1/13.htm">关于讲座安排的通知</a> 说明 2026年3月7日</li>
<li><a href="/info/1/11.htm">关于机器人竞赛报名的通知</a></li>
<li><a href="http://other.example/info/1/9.htm">别处的竞赛通知一则</a></li>
</ul><a href="p2.htm">下一页&gt;</a></body></html>"""
SECOND = '<div><a href="/info/2/21.htm">第二页的竞赛通知</a></div><a href="p2.htm">下页</a>'
ARTICLE = '<html><head><title>t</title><meta name="ArticleTitle" content="第二页的竞赛通知"></head><body><p>发布时间：2026-02-02</p><p>2020-01-01</p></body></html>'


def pages(spark):
    rows = [("s", "http://a.example/p1.htm", LIST), ("s", "http://a.example/p2.htm", SECOND), ("s", "http://a.example/info/2/21.htm", ARTICLE), ("s", "http://a.example/seed.htm", "<h1>Seeded notice</h1>"), ("t", "http://b.example/", ""), ("u", "http://c.example/", None)]
    return spark.createDataFrame(rows, "source string, url string, html string")


def sources(spark):
    rows = [("s", "http://a.example/p1.htm", r"/info/\d+/\d+\.htm", "竞赛", 3, ["http://a.example/seed.htm"]), ("t", "http://b.example/", r"/info/", None, 3, [])]
    return spark.createDataFrame(rows, "source string, url string, pattern string, keywords string, max_pages int, seeds array<string>")


def test_crawl(spark):
    assert sorted((r.source, r.url[-6:], r.depth) for r in lists.visited(pages(spark), sources(spark)).collect()) == [("s", "p1.htm", 1), ("s", "p2.htm", 2), ("t", "ample/", 1)]
    rows, status = lists.crawled(pages(spark), sources(spark))
    assert sorted((r.url[-6:], r.title, r.date) for r in rows.collect()) == [("11.htm", "关于机器人竞赛报名的通知", "2026-03-01"), ("12.htm", "数学建模竞赛", "2026-03-05"), ("21.htm", "第二页的竞赛通知", "2026-02-02"), ("ed.htm", "Seeded notice", "")]
    assert {r.source: (r.pages, r.listed, r["count"], r.missing_dates, r.state) for r in status.collect()} == {"s": (2, 4, 4, 1, "partial"), "t": (1, 0, 0, 0, "needs_adapter_or_unavailable")}


def test_many_pages(spark):
    """A source of 17 pages gives all 17, and one that its cap cuts says so."""
    page = lambda i: f'<a href="/info/1/{i}.htm" title="第{i}页的竞赛通知一则">x</a><span class="date">2026-03-01</span><a href="p{i + 1}.htm">下一页</a>'
    rows = [(s, f"http://a.example/p{i}.htm", page(i)) for s in "abc" for i in range(1, 18)]
    found = spark.createDataFrame(rows, "source string, url string, html string")
    made = [(s, "http://a.example/p1.htm", r"/info/", None, cap, []) for s, cap in (("a", 17), ("b", 6), ("c", None))]
    got, status = lists.crawled(found, spark.createDataFrame(made, "source string, url string, pattern string, keywords string, max_pages int, seeds array<string>"))
    assert {r.source: r.n for r in got.groupBy("source").agg(F.count("*").alias("n")).collect()} == {"a": 17, "b": 6, "c": 3}
    assert {r.source: (r.pages, r.state) for r in status.collect()} == {"a": (17, "ok"), "b": (6, "partial"), "c": (3, "partial")}


def test_other_scans(spark):
    got = lists.regex_rows(pages(spark).filter("source = 's'"), r'<a href="(/info/\d/\d+\.htm)"[^>]*>([^<]*)</a>', ("path", "label"))
    assert ("/info/1/13.htm", "关于讲座安排的通知") in [(r.path, r.label) for r in got.collect()]
    answers = spark.createDataFrame([("a", 1, '{"success":true,"items":[{"id":"1","title":"x","date":"d"},{"id":"","title":"y","date":"d"}]}'), ("a", 2, '{"success":true,"items":[{"id":"2","title":"x","date":"d"}]}'), ("a", 3, '{"success":true,"items":[{"id":"3","title":"x","date":"d"},{"id":"4","title":"x","date":"d"}]}'), ("b", 1, '{"success":false,"items":[{"id":"9","title":"x","date":"d"}]}'), ("b", 2, "broken")], "source string, page int, body string")
    assert sorted(r.id for r in lists.api_pages(answers, "id:string,title:string,date:string", 2).collect()) == ["1", "2"]
    found = spark.createDataFrame([("q", "u", 'x<li id="r"><h3><em>One</em> &amp; two</h3><i t="86400"></i><li id="r"><h3>Three</h3>'), ("q", "v", 'please verify <li id="r"><h3>No</h3>')], "source string, url string, html string")
    got = lists.search_results(found, '<li id="r">', {"title": "<h3>(.*?)</h3>", "epoch": 't="([0-9]+)"'}, "verify")
    assert sorted((r.title, r.date or "") for r in got.collect()) == [("One & two", "1970-01-02"), ("Three", "")]
    raw = "文字".encode()
    bodies = spark.createDataFrame([(1, raw, ""), (2, gzip.compress(raw), "gzip"), (3, zlib.compress(raw), "deflate"), (4, raw[:4], None), (5, None, None), (6, b"no", "gzip")], "i int, b binary, k string")
    assert [r.t for r in bodies.select("i", lists.decoded(F.col("b"), F.col("k")).alias("t")).orderBy("i").collect()] == ["文字", "文字", "文字", "文�", None, None]


def test_plans(spark):
    history = spark.createDataFrame([("u", i, "failed", "HTTP 503") for i in range(8)] + [("v", 1, "success", ""), ("v", 2, "failed", "x")], "url string, at int, status string, error string")
    got = {r.url: (r.attempts, len(r.recent), r.recent[0].at) for r in crawl.attempts(history).collect()}
    assert got == {"u": (8, 6, 2), "v": (2, 2, 1)}
    assert {r.url: r.state for r in crawl.queue_state(spark.createDataFrame([("u",), ("v",), ("w",)], "url string"), history).collect()} == {"u": "failed", "v": "success", "w": "pending"}
    assert {r.url: (r.status, r.last_success and r.last_success.at) for r in assembly.last_success(history).collect()} == {"u": ("failed", None), "v": ("failed", 1)}
    tries = spark.createDataFrame([("failed", "HTTP 502", 1), ("failed", "timed out", 2), ("failed", "timed out", 3), ("failed", "HTTP 404", 1), ("success", "", 1)], "s string, e string, n int")
    assert [r.w for r in tries.select(crawl.next_try(F.col("s"), F.col("e"), F.col("n")).alias("w")).collect()] == [1.0, 2.0, None, None, None]
    cache = spark.createDataFrame([("a", "success", True, "h", "2026-01-01 00:00:00"), ("b", "failed", False, "", "2026-01-09 20:00:00"), ("c", "failed", False, "", "2026-01-01 00:00:00"), ("d", "success", False, "h", "2026-01-01 00:00:00")], "url string, status string, has_html boolean, content_hash string, at string").withColumn("fetched_at", F.to_timestamp_ntz("at"))
    todo = crawl.still_to_do(spark.createDataFrame([(x,) for x in "abcde"], "url string"), cache, F.to_timestamp_ntz(F.lit("2026-01-10 12:00:00")))
    assert sorted(r.url for r in todo.collect()) == ["c", "d", "e"]


def test_lines_and_names(spark):
    rows = [("p", 100.0, 1.0, "a"), ("p", 98.5, 2.0, "b"), ("p", 97.0, 3.0, "c"), ("p", 96.0, 0.0, "d"), ("q", 5.0, 1.0, "e")]
    got = layout.same_lines(spark.createDataFrame(rows, "page string, y double, x double, t string"), "page", "y", "x", "t")
    assert sorted((r.page, r.y, r.text) for r in got.collect()) == [("p", 97.0, "dc"), ("p", 100.0, "ab"), ("q", 5.0, "e")]
    names = spark.createDataFrame([(1, "x", "h"), (2, "x", "h"), (3, "x (h)", "k"), (4, "y", "h")], "i int, n string, s string")
    assert [r.n for r in merging.disambiguate(names, "n", F.col("s"), [F.col("i")]).orderBy("i").collect()] == ["x", "x (h)", "x (h) (k)", "y"]
    links = spark.createDataFrame([([("link", "a"), ("file", "b"), ("form", "c"), ("file", "d")],)], "l array<struct<kind:string,url:string>>")
    assert [x.url for x in links.select(views.link_order(F.col("l")).alias("l")).first().l] == ["c", "b", "d", "a"]
