import io
import time
import zipfile

from pyspark.sql import functions as F

from tidewell.operators import assembly, notices
from tidewell.operators.results import Store
from tidewell.plans import programs
from tidewell.sources import documents


def docx(*texts):
    out = io.BytesIO()
    body = "".join(f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>" for t in texts)
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def test_docx(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(docx("One", " ", "Two"))
    (tmp_path / "b.docx").write_bytes(b"no archive")
    got = {r.path[-6:]: (r.status, list(r.paragraphs)) for r in documents.docx(spark.read.format("binaryFile").load(str(tmp_path))).collect()}
    assert got == {"a.docx": ("success", ["One", "Two"]), "b.docx": ("failed: BadZipFile", [])}


def test_catalogue():
    lines = ["1 Robot contest http://example.edu/a", "bc", "2 Math", "modelling www.example.edu", "- 1 -", "4 Chemistry", "17 not an item"]
    got = documents.parse_items(lines)
    assert [(i["no"], i["name"], i["url"], i["page"]) for i in got] == [(1, "Robot contest", "http://example.edu/abc", 1), (2, "Mathmodelling", "www.example.edu", 1), (4, "Chemistry17 not an item", "", 2)]
    assert got[2]["warnings"] == ["skipped 3"]


def test_weekly_program(spark):
    kinds = "url string, title string, date string, source string"
    old = spark.createDataFrame([("u1", "Robot Contest 2024", "2024-03-01", "s"), ("u2", "Robot Contest 2025", "2025-03-09", "s"), ("u3", "Other", "2025-01-01", "s")], kinds)
    new = spark.createDataFrame([("u3", "Math Contest", None, None), ("u4", "Robot Contest 2026", "2026-04-01", "t")], kinds)
    found = programs.weekly(old, new, [("Robot Contest", "Robot"), ("Math", "Math")])
    assert {r.url: (r.competition, r.date) for r in found.collect()} == {"u1": ("Robot", "2024-03-01"), "u2": ("Robot", "2025-03-09"), "u3": ("Math", "2025-01-01"), "u4": ("Robot", "2026-04-01")}
    site = programs.site_competitions(spark.createDataFrame([("Robot",), ("Math",), ("None",)], "name string"), found, F.to_date(F.lit("2026-05-01")))
    got = {r.name: (r.notices, r.latest and r.latest.url, r.recent, r.window_start, r.window_end) for r in site.collect()}
    assert got == {"Robot": (3, "u4", True, 3, 3), "Math": (1, "u3", False, None, None), "None": (0, None, False, None, None)}
    assert "SUMMARY:Robot\\, 3-3" in programs.calendar_events(site, 2026).first().event
    assert [r.url for r in programs.search(found, "robot-contest").collect()] == ["u4", "u2", "u1"]


def test_calendars(spark):
    windows = spark.createDataFrame([("Robot", 3, 5), ("Math, applied", 1, 1), ("None", None, None)], "competition string, window_start int, window_end int")
    master = spark.createDataFrame([("Robot", 12, 5), ("Math, applied", None, 2)], "name string, number int, score int")
    got = {r.calendar: r.text for r in programs.calendars(windows, master, F.to_date(F.lit("2026-02-10")), F.lit("20260210T000000Z"), "-//x", "c").collect()}
    assert set(got) == {"all", "core"} and got["all"].count("BEGIN:VEVENT") == 2 and got["core"].count("BEGIN:VEVENT") == 1
    assert "UID:moe12\r\nDTSTART;VALUE=DATE:20260301\r\n" in got["core"] and "DTSTART;VALUE=DATE:20270101" in got["all"] and "SUMMARY:Math\\, applied 1月\r\n" in got["all"] and "SUMMARY:Robot 3月-5月" in got["core"]
    assert all(len(line.encode()) <= 75 for t in got.values() for line in t.split("\r\n")) and got["all"].endswith("END:VCALENDAR\r\n")


def test_deadlines_still_there(spark):
    docs = spark.createDataFrame([("u", "报名截止：2026年3月20日。", "2026-01-01"), ("v", "报名截止：2026年4月1日。", "2026-01-01")], "url string, body string, date string")
    events = notices.events(docs, "url", "body", "date")
    changed = docs.withColumn("body", F.when(F.col("url") == "v", "正文已改。").otherwise(F.col("body")))
    assert {r.url: r.safe for r in programs.deadline_map(events, changed).collect()} == {"u": "2026-03-20"}


def test_article_queue(spark):
    found = spark.createDataFrame([("a", "A"), ("a", "A"), ("b", "B"), ("c", "C"), ("d", "D"), ("", "x"), (None, "y")], "url string, title string")
    history = spark.createDataFrame([("a", 1, "success", ""), ("b", 1, "failed", "HTTP 503")] + [("c", i, "failed", "HTTP 503") for i in range(3)], "url string, at int, status string, error string")
    got = {r.url: (r.state, r.attempts, r.error, r.wait) for r in programs.article_queue(found, history).collect()}
    assert got == {"a": ("success", 1, None, None), "b": ("pending", 1, "HTTP 503", 1.0), "c": ("failed", 3, "HTTP 503", None), "d": ("pending", 0, None, 0.0)}


def test_listing_run(spark):
    page = '<ul><li><a href="/info/1/1.htm" title="关于机器人竞赛报名的通知">x</a><span class="date">2026-03-01</span></li></ul>'
    pages = spark.createDataFrame([("s", "http://a.example/l.htm", page)], "source string, url string, html string")
    sources = spark.createDataFrame([("s", "http://a.example/l.htm", "/info/", None, 1, [])], "source string, url string, pattern string, keywords string, max_pages int, seeds array<string>")
    known = spark.createDataFrame([("http://a.example/info/1/1.htm", "old title", None, "s"), ("http://b.example/", "化学（竞赛）", "2025-01-01", "t")], "url string, title string, date string, source string")
    names = spark.createDataFrame([("机器人竞赛", "Robot", 0), ("竞赛", "Any", 1), ("化学竞赛", "Chemistry", 2)], "name string, target string, rank int")
    found, status = programs.listing_run(known, pages, sources, names)
    assert {r.url[-6:]: (r.title, r.date, r.competition) for r in found.collect()} == {"/1.htm": ("关于机器人竞赛报名的通知", "2026-03-01", "Robot"), "ample/": ("化学（竞赛）", "2025-01-01", "Chemistry")}
    assert status.first().state == "ok"


def test_field_run(spark, tmp_path):
    store = Store(spark, tmp_path.as_uri(), programs.FACTS)
    kinds = "url string, title string, body string, status string"
    rows = [("a", "第三届机器人竞赛报名通知", "联系人：王老师，电话029-88888888", "success"), ("b", "食堂通知", "吃饭", "success"), ("c", None, None, "pending")]
    names = spark.createDataFrame([("机器人竞赛", "Robot", "A", 0)], "name string, target string, category string, rank int")
    worked, found = programs.field_run(store, spark.createDataFrame(rows, kinds), "1", names, ("A",))
    got = {r.url: (r.facts_state, r.state, r.eligible, {f.field: f.value for f in r.facts}) for r in found.collect()}
    assert worked == 3 and got["a"] == ("fresh", "target", True, {"competitionNames": "第三届机器人竞赛", "editions": "第三届", "contacts.name": "王老师", "contacts.phones": "029-88888888"})
    assert got["b"][:3] == ("fresh", "excluded", False) and got["c"] == ("fresh", "review", False, {})
    again = [*rows[:1], ("b", "食堂通知", "第五届", "success"), rows[2]]
    worked, found = programs.field_run(store, spark.createDataFrame(again, kinds), "1", names, ("A",))
    assert worked == 1 and {r.url: [f.value for f in r.facts] for r in found.collect()}["b"] == ["第五届"]
    assert programs.field_run(store, spark.createDataFrame(again, kinds), "1", names, ("A",))[0] == 0


def test_names_many_times(spark):
    """Equal names and numbers pair once each: 4 billion pairs of rows before."""
    rows = spark.range(60000).select(F.col("id").alias("row_id"), (F.col("id") % 2).cast("int").alias("no"), F.when(F.col("id") < 7, "other").otherwise("Red Widget").alias("name"))
    names = spark.range(60000).select(F.col("id").alias("name_id"), F.when(F.col("id") % 3 == 0, 1).alias("no"), F.when(F.col("id") % 3 == 1, "the red widget").when(F.col("id") % 6 == 2, "widget").otherwise("other").alias("name"))
    began = time.time()
    got = assembly.match_names(rows, names).groupBy(F.col("name_id") % 6, "row_id").count().collect()
    assert sorted(map(tuple, got)) == [(0, 1, 10000), (1, 7, 10000), (2, 7, 10000), (3, 1, 10000), (4, 7, 10000), (5, 0, 10000)]
    assert time.time() - began < 60
