import pytest
from pyspark.sql import functions as F

from tidewell.operators import decisions
from tidewell.operators.results import Conflict, Store


def texts(spark, rows):
    return spark.createDataFrame(rows, "key string, content string, text string")


def lengths(todo):
    """A result for each text; "bad" fails, "lost" is left out."""
    return todo.filter("text <> 'lost'").select("key", F.length("text").alias("result"), F.when(F.col("text") == "bad", "broken").alias("error"))


def at(day):
    return F.to_timestamp(F.lit(day))


def test_only_what_changed(spark, tmp_path):
    store = Store(spark, tmp_path.as_uri(), "int")
    rows = [("a", "h1", "x"), ("b", "h2", "yy"), ("c", "h3", "bad"), ("d", "h4", "lost"), (None, "h5", "no")]
    df = texts(spark, rows)
    assert store.current(df, "v1").filter("state <> 'pending'").count() == 0
    assert store.refresh(df, lengths, "v1", now=at("2026-01-01")) == 4
    assert store.refresh(df, lengths, "v1", now=at("2026-01-01 10:00:00")) == 0 and store.snapshot()[0] == 1
    assert {r.key: (r.state, r.result) for r in store.current(df, "v1").collect()} == {"a": ("fresh", 1), "b": ("fresh", 2), "c": ("failed", None), "d": ("failed", None), None: ("pending", None)}
    changed = texts(spark, [("a", "h1", "x"), ("b", "h9", "bad"), ("c", "h3", "bad")])
    assert {r.key: r.state for r in store.current(changed, "v1").collect()} == {"a": "fresh", "b": "stale", "c": "failed"}
    assert store.refresh(changed, lengths, "v1", now=at("2026-01-01 11:00:00")) == 1
    assert {r.key: (r.state, r.result) for r in store.current(changed, "v1").collect()} == {"a": ("fresh", 1), "b": ("stale", 2), "c": ("failed", None)}
    assert store.refresh(texts(spark, rows), lengths, "v1", now=at("2026-01-03")) == 2  # failures, after their rest
    assert store.refresh(df, lengths, "v2", now=at("2026-01-04")) == 4 and store.refresh(df, lengths, "v2", "other", now=at("2026-01-04")) == 4
    before = sorted(map(str, store.newest().collect()))
    store.compact()
    assert len(store.snapshot()[1]) == 1 and sorted(map(str, store.newest().collect())) == before
    assert store.refresh(df, lengths, "v2", now=at("2026-01-04 01:00:00")) == 0


def test_two_writers(spark, tmp_path):
    store = Store(spark, tmp_path.as_uri(), "int")
    df = texts(spark, [("a", "h1", "x")])

    def slow(todo):
        Store(spark, tmp_path.as_uri(), "int").refresh(df, lengths, "v1")
        return lengths(todo)

    with pytest.raises(Conflict):
        store.refresh(df, slow, "v1")
    assert store.snapshot()[0] == 1 and store.rows().count() == 1


def test_classified(spark):
    names = spark.createDataFrame([("全国机器人大赛", "机器人", "A", 0), ("robocon", "机器人", "A", 1), ("蓝桥杯大赛", "蓝桥杯", "C", 2), ("钓鱼比赛", "钓鱼", "其他", 3), ("robomaster", "RM", "A", 4)], "name string, target string, category string, rank int")
    out = spark.createDataFrame([("机器人", "robomaster|robotac", "robocon")], "target string, pattern string, but string")
    rows = [
        ("1", "“全国机器人大赛”报名通知", "", "success"), ("2", "全国机器人大赛获奖名单公示", "", "success"), ("3", "蓝桥杯大赛报名延长", "", "success"), ("4", "蓝桥杯大赛报名", "智能装备数字化建模", "success"), ("5", "钓鱼比赛报名", None, "success"),
        ("6", "全国机器人大赛与钓鱼比赛", None, "success"), ("7", "食堂通知", "吃饭", "success"), ("8", "食堂通知", None, "pending"), ("9", "RoboMaster 全国机器人大赛招募", "", "success"), ("10", None, None, None),
    ]
    df = decisions.classified(spark.createDataFrame(rows, "url string, title string, body string, status string"), names, ("A", "B", "C"), out, [("蓝桥杯", "智能装备数字化建模")])
    got = {r.url: (r.state, r.reason, r.primary, r.eligible, r.requires_review, len(r.matches)) for r in df.collect()}
    assert got == {
        "1": ("target", "unique_title_match", "registration", True, False, 1), "2": ("target", "unique_title_match", "award", False, False, 1), "3": ("review", "track_unconfirmed", "postponement", False, True, 1), "4": ("target", "unique_title_match", "registration", True, False, 1),
        "5": ("excluded", "outside_target_catalog", "registration", False, False, 1), "6": ("review", "multiple_competitions", "unknown", False, True, 2), "7": ("excluded", "no_competition_evidence", "unknown", False, True, 0), "8": ("review", "insufficient_evidence", "unknown", False, True, 0),
        "9": ("target", "unique_title_match", "recruitment", True, False, 1), "10": ("review", "insufficient_evidence", "unknown", False, True, 0),
    }
    types = {r.url: [(t.type, t.start, t.end, t.raw) for t in r.types] for r in df.collect()}
    assert types["2"] == [("award", 7, 9, "获奖"), ("results", 7, 11, "获奖名单")]
