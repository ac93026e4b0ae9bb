from pyspark.sql import functions as F

from tidewell.operators import display, editions, linking, notices, ranking, views


def test_groups_and_cards(spark):
    kinds = "url string, title string, date string, competition string, edition_id string, year int, edition int, track string, phase string, stage string, content_hash string, has_fields boolean, site string"
    rows = [
        ("u1", "机器人 竞赛", "2026-03-02", "r", "e1", 2026, None, None, None, None, "h", False, "a"), ("u2", "【转载】机器人竞赛", "2026-03-05", "r", "e1", 2026, None, None, None, None, "h", True, "b"),
        ("u3", "机器人竞赛", "2026-03-02", "r", "e1", 2026, None, None, None, None, None, False, "a"), ("u4", "机器人竞赛", "2026-03-02", "r", "e1", 2026, None, None, None, None, "", False, "c"),
        ("u5", "旧通知", None, "r", "x5", None, None, None, None, None, None, None, "a"), ("u6", "旧通知", None, "r", "x6", None, None, None, None, None, None, None, "a"), ("u7", "无", "2026-01-01", None, None, None, None, None, None, None, None, None, "a"),
    ]
    shown = display.grouped(spark.createDataFrame(rows, kinds))
    assert {r.url: r.group_url for r in shown.collect()} == {"u1": "u2", "u2": "u2", "u3": "u3", "u4": "u3", "u5": "u5", "u6": "u6", "u7": "u7"}
    assert sorted((r.group_url, r.url, r.label) for r in display.repost_sources(shown, "site").collect()) == [("u2", "u1", "a"), ("u2", "u2", "b"), ("u3", "u3", "a"), ("u3", "u4", "c")]
    docs = spark.createDataFrame([("u2", "2026-03-05", "报名截止：2026年3月20日。"), ("u3", "2026-03-15", "报名截止延期至2026年4月10日。"), ("u5", "2026-03-20", "报名截止2月30日")], "url string, date string, body string")
    none = F.lit(None).cast("string")
    about = docs.select("url", "date", F.lit("r").alias("competition"), F.when(F.col("url") == "u5", "x5").otherwise("e1").alias("edition_id"), none.alias("phase"), none.alias("stage"))
    slots = editions.slots(about, notices.events(docs, "url", "body", "date"))
    assert [tuple(r) for r in display.revision_links(slots, shown).collect()] == [("u3", "u2", "【转载】机器人竞赛", "applied")]
    got = [(r.shelf, r.position, r.url, r.deadline) for r in display.cards(shown, slots, spark.createDataFrame([("e1",)], "edition_id string")).orderBy("shelf", "position").collect()]
    assert [g[:3] for g in got] == [("archive", 1, "u5"), ("archive", 2, "u6"), ("current", 1, "u2"), ("current", 2, "u3")]
    assert got[0][3] == display.UNSURE and got[1][3] == display.NOTHING and got[2][3] == got[3][3] and "10" in got[2][3]


def test_places_and_names(spark):
    df = spark.range(5000).select("id", (F.col("id") * 7919 % 1009).alias("x")).repartition(5)
    got = {r.id: r.place for r in ranking.numbered(df, ["id"], [F.desc("x"), F.col("id")]).collect()}
    want = sorted(range(5000), key=lambda i: (-(i * 7919 % 1009), i))
    assert [got[i] for i in want] == list(range(1, 5001))
    names = spark.createDataFrame([(n, 1) for n in ["数学", "机器人", "Abc", "化学", "电子", "啊"]], "name string, score int")
    assert [r.name for r in names.orderBy(*views.competition_order("name", "zh")).collect()] == ["啊", "电子", "化学", "机器人", "数学", "Abc"]
    assert [r.name for r in names.orderBy(*views.competition_order("name")).collect()] == sorted(r.name for r in names.collect())


def test_short_passages(spark):
    texts = spark.createDataFrame([(1, "one two three"), (None, "two"), (2, None), (3, "")], "k int, t string")
    passages = spark.createDataFrame([("a", "two"), ("b", "e t"), ("c", ""), ("d", None), ("e", "two")], "i string, p string")
    got = sorted((str(r.k), r.i) for r in linking.contained_passages(texts, "k", "t", passages, "p").collect())
    assert got == [("1", "a"), ("1", "b"), ("1", "e"), ("None", "a"), ("None", "e")]
