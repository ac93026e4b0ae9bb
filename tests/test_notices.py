import pytest
from pyspark.sql import functions as F

from tidewell.functions.html import Page, articles
from tidewell.operators import notices

CASES = [
    (1, "报名截止：2026年11月25日下午3点30分。", "2026-10-01"),
    (2, "报名截止：1月5日。", "2026-12-10"),
    (3, "报名截止2026年2月30日。", "2026-01-01"),
    (4, "报名截止：2026年11月20日，现延期至2026年11月25日。", "2026-10-01"),
    (5, "报名开始2026年10月1日。报名截止2026年10月20日24:00。作品提交2026年11月1日", "2026-09-01"),
    (6, None, "2026-01-01"),
    (7, "报名截止：2026年11月25日25:61。", "2026-10-01"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(CASES, "id int, body string, day string")


def test_events(docs):
    got = {}
    for r in notices.events(docs, "id", "body", "day").orderBy("id", "start").collect():
        got.setdefault(r.id, []).append((r.kind, r.value, r.time, sorted(r.flags), r.verification, r.superseded))
    assert got[1] == [("registration_deadline", "2026-11-25", "15:30", [], "source_matched", False)]
    assert got[2] == [("registration_deadline", "2026-01-05", None, ["before_publication", "missing_year", "possible_cross_year"], "needs_review", False)]
    assert got[3][0][3] == ["invalid_date"]
    assert [(e[1], "conflict" in e[3], e[5]) for e in got[4]] == [("2026-11-20", True, True), ("2026-11-25", True, False)]
    assert [e[:3] for e in got[5]] == [("registration_start", "2026-10-01", None), ("registration_deadline", "2026-10-20", "24:00"), ("submission", "2026-11-01", None)]
    assert 6 not in got and got[7][0][3] == ["invalid_time"]
    assert notices.check_evidence(notices.events(docs, "id", "body", "day"), docs, "id", "body").count() == 0


def test_safe_deadline_and_status(docs):
    found = notices.events(docs, "id", "body", "day")
    assert {r.id: r.safe for r in notices.safe_deadlines(found, "id").collect()} == {1: "2026-11-25", 2: None, 3: None, 4: None, 5: "2026-10-20", 7: None}
    status = {r.id: r.status for r in notices.registration(found, "id", F.lit("2026-10-04 12:00")).collect()}
    assert status[1] == "open" and status[5] == "open" and status[4] == "open" or status[4] == "conflict"


def test_identity(spark):
    titles = ["第十二届机器人设计大赛校赛通知", "2026年第3届挑战赛", "第二十届 与 第21届", "关于2026年竞赛"]
    got = [tuple(r.i) for r in spark.createDataFrame([(t,) for t in titles], "t string").select(notices.identity(F.col("t")).alias("i")).collect()]
    assert got == [(None, 12, "campus"), (2026, 3, None), (None, None, None), (2026, None, None)]


def test_bridge(spark):
    rows = [("c", 1, 2026, 12), ("c", 2, None, 12), ("c", 3, 2026, None), ("c", 4, None, None), ("d", 5, None, 3), ("e", 6, 2025, 1), ("e", 7, 2025, 2), ("e", 8, 2025, None)]
    df = spark.createDataFrame(rows, "c string, id int, year int, edition int")
    got = {r.id: (r.year, r.edition) for r in notices.bridge_editions(df, "c", "id").collect()}
    assert got == {1: (2026, 12), 2: (2026, 12), 3: (2026, 12), 4: (None, None), 5: (None, 3), 6: (2025, 1), 7: (2025, 2), 8: (2025, None)}


def test_states_contacts_reposts(spark):
    df = spark.createDataFrame([(1, "关于报名的通知", "success", "a@example.edu QQ群：123456 029-88888888", "2026-01-02"), (2, "[转] 关于报名的通知", "success", "", "2026-01-03"), (3, "获奖名单公示", "success", None, ""), (4, "竞赛", "failed", None, "")], "id int, t string, s string, b string, d string")
    assert [r.x for r in df.select(notices.state(F.col("t"), F.col("s")).alias("x")).collect()] == ["target", "target", "excluded", "review"]
    first = notices.contacts(df, "id", "b").orderBy("id").first()
    assert (list(first.emails), list(first.phones), list(first.qq)) == (["a@example.edu"], ["029-88888888"], ["123456"])
    assert sorted((r.representative, r.members) for r in notices.repost_groups(df, "t", "d", "id").collect()) == [(1, 2), (3, 1), (4, 1)]


def test_html(spark):
    html = '<html><title> A &amp; B</title><nav><a href="/x">n</a></nav><article><h1>Head</h1><p>One <b>two<p>Three</p><table><tr><td>c1<td>c2</tr></table><a href="/f.pdf">f</a><img src="i.png"></b></article><footer>end</footer>'
    page = Page(html)
    assert page.headings == ["Head"] and page.paragraphs[:2] == ["One two", "Three"] and page.links == ["/f.pdf"] and page.images == ["i.png"] and len(page.tables) == 1
    df = spark.createDataFrame([(1, html), (2, None), (3, "")], "id int, html string")
    got = {r.id: r for r in articles(df, "id", "html").collect()}
    assert got[1].title == "A & B" and got[2].content_hash == got[3].content_hash
