import pytest
from pyspark.sql import functions as F

from tidewell.functions import facts, text
from tidewell.operators import diagnosis, editions, notices

NOTICES = [
    ("u1", "2026-03-01", "第十二届机器人竞赛报名通知", "报名截止：2026年3月20日。"),
    ("u2", "2026-03-15", "第十二届机器人竞赛报名延期通知", "原报名截止2026年3月20日，现延期至2026年4月10日。"),
    ("u3", "2026-03-15", "机器人竞赛补充", "报名截止延期至2026年5月1日。"),
    ("u4", "2026-06-01", "机器人竞赛获奖名单", "作品提交截至6月10日"),
]


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame(NOTICES, "url string, date string, title string, body string")
    none = F.lit(None).cast("string")
    about = docs.select("url", "date", "title", F.lit("robot").alias("competition"), F.lit("e1").alias("edition_id"), none.alias("phase"), none.alias("stage"), none.alias("track"), editions.identity(F.col("title"))["notice_type"].alias("notice_type"))
    return about, notices.events(docs, "url", "body", "date")


def test_dates(spark):
    rows = [
        ("报名2026年3月5日开始，校赛3月5日截止；2026年3月5日决赛", "2026-01-01", [("other", "2026-03-05", 2), ("other", "2026-03-05", 16), ("competition", "2026-03-05", 23)]),
        ("报名时间：2025年12月20日至1月10日下午5点半", "2025-12-01", [("registration_start", "2025-12-20", 5), ("registration_deadline", "2026-01-10", 17)]),
        ("比赛3月1日至3月4日", "2026-01-01", [("competition", "2026-03-01", 2), ("competition", "2026-03-04", 7)]),
        ("本校报名截止2月30日", "2026-02-01", [("campus_deadline", None, 6)]),
        ("材料次年1月5日前提交", "2026-02-01", [("submission", "2027-01-05", 4)]),
        ("2026年3月至5月竞赛", "", [("competition", None, 0)]),
        (None, None, []),
        ("", "2026-01-01", []),
    ]
    df = facts.date_events(spark.createDataFrame([(i, t, d) for i, (t, d, _) in enumerate(rows)], "i int, t string, d string"), "t", "d", "e")
    got = {r.i: [(e.kind, e.value, e.start) for e in r.e] for r in df.collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(rows)}
    flags = {r.i: [sorted(e.flags) for e in r.e] for r in df.collect()}
    assert flags[1] == [[], ["cross_year"]] and flags[2] == [["date_range", "missing_year"], ["missing_year", "range_endpoint"]] and flags[3] == [["invalid_date", "missing_year"]] and flags[5] == [["month_precision"]]


def test_rounds(spark):
    cases = {"十": 10, "十二": 12, "二十": 20, "三十一": 31, "一百零二": 102, "一百二十": 120, "7": 7, "百": 100, "x": None, "〇": 0}
    got = spark.createDataFrame([(k,) for k in cases], "t string").select("t", editions.round_number(F.col("t")).alias("n")).collect()
    assert {r.t: r.n for r in got} == cases


def test_identity(spark):
    titles = ["2026年第十二届机器人竞赛校内选拔决赛报名通知", "2025-2026赛季挑战赛获奖名单", "2025年 2026年 竞赛延期", None]
    got = [tuple(r.i) for r in spark.createDataFrame([(t,) for t in titles], "t string").select(editions.identity(F.col("t")).alias("i")).collect()]
    assert got[0] == (2026, 2026, 12, False, "campus", "决赛", "registration")
    assert got[1] == (2025, 2026, None, False, None, None, "results")
    assert got[2] == (None, None, None, True, None, None, "postponement") and got[3][:4] == (None, None, None, False)


def test_scoped_clues(spark):
    names = F.array(F.lit("机器人大赛"), F.lit("赛"))
    texts = ["关于举办2026年（第八届）机器人大赛的通知", "往届2020年机器人大赛，机器人大赛（2027）", "机器人大赛将于2026年5月在本校举办", "2024-2025赛季机器人大赛", "没有年份的机器人大赛", "2019年，机器人大赛"]
    got = [[tuple(c) for c in r.c] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(editions.scoped_clues(F.col("t"), names).alias("c")).collect()]
    assert got == [[(2026, 2026, 8)], [(2027, 2027, None)], [(2026, 2026, None)], [(2024, 2025, None)], [], []]


def test_slots(found):
    made = {(r.kind): r for r in editions.slots(*found).collect()}
    deadline = made["registration_deadline"]
    # The second notice moves the first one's date; the third, of the same day, may not and stays for review.
    assert [e.value for e in deadline.entries] == ["2026-04-10", "2026-05-01"]
    assert sorted(deadline.entries[1].flags) == ["postponed", "unresolved_revision"]
    assert "2026-03-20" in [e.value for e in deadline.history] and deadline.applied == 1 and deadline.pending == 1 and deadline.state == "needs_review"
    assert made["submission"].state == "needs_review"


def test_status(spark, found):
    about, events = found
    made = editions.slots(about, events.filter("url in ('u1', 'u2')"))
    at = lambda day, who=about: {r.status for r in editions.slot_status(made, who, F.to_timestamp_ntz(F.lit(day))).collect()}
    early = about.filter("url <> 'u4'")
    assert at("2026-04-10 12:00:00", early) == {"open"} and at("2026-04-11 00:00:00", early) == {"closed"} and at("2026-04-01 00:00:00") == {"closed"}
    status = editions.slot_status(made, early, F.to_timestamp_ntz(F.lit("2026-04-01")))
    one = editions.edition_registration(status, spark.createDataFrame([("e1", True), ("e2", True), ("e3", False)], "edition_id string, complete boolean"))
    assert {r.edition_id: (r.status, r.next_deadline) for r in one.collect()} == {"e1": ("open", "2026-04-10"), "e2": ("not_mentioned", None), "e3": ("needs_review", None)}


def test_diagnosis(spark):
    docs = spark.createDataFrame([("u", "详见附件报名表。扫码进群。"), ("v", "没有")], "url string, body string")
    assets = spark.createDataFrame([("u", "attachment", "a1", "附件报名表"), ("v", "image", "i1", "")], "url string, kind string, asset string, text string")
    resources = spark.createDataFrame([("a1", "failed", 0)], "asset string, status string, chunks int")
    got = {(r.url, r.kind): (r.state, sorted(r.fields)) for r in diagnosis.resource_hints(docs, assets, resources).collect()}
    assert got[("u", "attachment")] == ("resource_failed", ["registrationLinks", "registrationMethods", "requiredMaterials"])
    assert got[("u", "reference")] == ("resource_pending", ["groups"]) and got[("v", "image")][0] == "resource_pending"
    status = spark.createDataFrame([("needs_review", "no_current_notice", False, []), ("needs_review", "x", True, ["body_pending"]), ("needs_review", "x", True, ["conflict"]), ("open", "x", True, ["body_pending"])], "s string, p string, c boolean, e array<string>")
    assert [r.x for r in status.select(diagnosis.shown_status(F.col("s"), F.col("p"), F.col("c"), F.col("e")).alias("x")).collect()] == ["no_current_notice", "body_pending", "needs_review", "open"]


def test_names(spark):
    row = spark.range(1).select(
        text.competition_names(F.lit("关于举办第三届机器人竞赛、创新大赛的通知")).alias("n"), text.track_names(F.lit("机器人大赛“智能车赛道”（水下赛道）")).alias("t"),
        text.name_variants(F.lit("全国大学生机器人竞赛暨国际机器人挑战赛"), ["全国大学生"], ["挑战赛"]).alias("k"), text.article_url(F.lit("https://a.example/s?b=2&a=1&z=0"), "a.example", ("a", "b")).alias("u"),
        text.subdomains(F.lit("stu · example"), "example", ["www"]).alias("s"), text.first_contact(F.lit("联系人：王老师，电话029-88888888，a@b.cn，QQ：123456")).alias("c"), text.clean_spaces(F.lit(" a \t　b\nc ")).alias("p"),
    ).first()
    assert row.n == ["第三届机器人竞赛、创新大赛"] and sorted(row.t) == ["智能车赛道", "水下赛道"]
    assert row.k == ["全国大学生机器人竞赛暨国际机器人挑战赛", "机器人竞赛暨国际机器人挑战赛", "全国大学生机器人竞赛暨国际机器人", "全国大学生机器人竞赛", "国际机器人挑战赛"]
    assert row.u == "https://a.example/s?a=1&b=2" and row.s == ["stu"] and tuple(row.c) == ("王老师", "029-88888888", "a@b.cn", "123456") and row.p == "a b\nc"


def test_many_dates_in_one_sentence(spark):
    """Work goes by the number of dates: what stands around each is cut, a range is told from its neighbours alone."""
    body = " ".join(f"报名{1 + i % 12}月{1 + i % 28}日至{1 + i % 12}月{1 + i % 28}日" for i in range(1500))
    found = notices.events(spark.createDataFrame([("u", body, "2026-01-01")], "url string, body string, date string"), "url", "body", "date")
    got = found.agg(F.count("*"), F.max(F.length("before")), F.count_distinct("begin"), F.count_if(F.array_contains("flags", "range_endpoint")), F.count_if("superseded")).first()
    assert tuple(got) == (3000, facts.AROUND, 1, 1500, 0)
