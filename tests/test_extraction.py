from pyspark.sql import functions as F

from tidewell.operators import extraction

BODY = """一、参赛对象
全日制本科学生均可报名
二、报名方式
请通过平台 https://a.example/signup 报名。主页：https://b.example/
三、联系方式
联系人：王老师，电话029-88888888，邮箱 w@a.cn
电话：13800000000
联系人：李明、张华，13911111111
QQ交流群：123456789，电话13700000000
水下赛道：
材料须提交报名表。第三届
其他 QQ：7654321"""


def test_fields(spark):
    docs = spark.createDataFrame([("u", "关于第十届机器人竞赛的通知", BODY), ("v", None, None), ("w", "", "")], "url string, title string, body string")
    images = spark.createDataFrame([("u", "i1", "竞赛QQ群二维码"), ("u", "i2", "照片")], "url string, image string, context string")
    links = spark.createDataFrame([("u", "https://c.example/enroll", "x"), ("u", "https://d.example/", "请通过平台"), ("u", "https://e.example/", "no")], "url string, link string, text string")
    found = extraction.extract(docs, links, images)
    got = {}
    for r in found.collect():
        got.setdefault(r.field, set()).add(r.value)
        assert r.verification == ("needs_review" if r.flags else "source_matched")
    assert extraction.false_evidence(found, docs).count() == 0
    assert got["competitionNames"] == {"第十届机器人竞赛"} and got["editions"] == {"第十届", "第三届"} and got["tracks"] == {"水下赛道"}
    assert got["audiences"] == {"全日制本科学生均可报名"} and "材料须提交报名表。" in got["requiredMaterials"]
    assert got["registrationLinks"] == {"https://a.example/signup", "https://c.example/enroll", "https://d.example/"} | ({"https://b.example/"} & got["registrationLinks"])
    assert got["groups.qq"] == {"123456789"} and got["groups.image"] == {"i1"} and got["contacts.qq"] == {"7654321"}
    assert got["contacts.name"] == {"王老师", "李明", "张华"}
    people = {}
    for r in found.filter("field like 'contacts.%'").collect():
        people.setdefault(r.item, {}).setdefault(r.field[9:], []).append((r.value, list(r.flags)))
    by_name = {p["name"][0][0]: p for p in people.values() if "name" in p}
    assert sorted(v for v, _ in by_name["王老师"]["phones"]) == ["029-88888888", "13800000000"] and by_name["王老师"]["emails"] == [("w@a.cn", [])]
    assert "phones" not in by_name["李明"] and [p["phones"] for p in people.values() if "name" not in p and "phones" in p and p["phones"][0][1]] == [[("13911111111", ["relationship_ambiguous"])]]
    assert {r.track for r in found.filter("field = 'requiredMaterials' and value like '材料%'").collect()} != {None}


def test_resources_and_model(spark):
    rows = [("n", "r1", "c1", "success", "ocr", "联系人：王老师，电话029-88888888"), ("n", "r1", "c2", "success", "qr", "https://q.example/x"), ("n", "r2", "c1", "failed", "ocr", "联系人：李老师"), ("n", "r3", "c1", "partial", "attachment", "第二届"), ("n", "r4", "c1", "success", "other", "第四届")]
    got = {(r.field, r.value): (r.at, r.method, sorted(r.flags)) for r in extraction.extract_resources(spark.createDataFrame(rows, "url string, resource string, chunk string, status string, method string, text string")).collect()}
    assert got[("contacts.name", "王老师")] == ("r1:c1", "ocr", ["ocr_requires_review"]) and got[("editions", "第二届")] == ("r3:c1", "attachment", [])
    assert got[("registrationLinks", "https://q.example/x")] == ("r1:c2", "qr", ["qr_purpose_unverified", "qr_requires_review"]) and ("editions", "第四届") not in got
    docs = spark.createDataFrame([("a", "t", "第三届大赛"), ("b", "t", "第三届大赛"), ("c", "t", "x")], "url string, title string, body string")
    rules = extraction.extract(docs)
    claim = lambda url, value, raw, start: (url, "audiences", None, value, raw, "body", None, start, start + len(raw), "model", [], "source_matched", None)
    claims = spark.createDataFrame([claim("a", "大赛", "大赛", 3), claim("a", "第三届", "第三届大赛", 0), claim("b", "大赛", "大赛", 0)], rules.schema)
    made = extraction.with_model(rules, claims, docs)
    assert {(r.url, r.value): (r.method, r.verification, r.model) for r in made.filter(F.col("field") == "audiences").collect()} == {("a", "大赛"): ("model", "needs_review", "accepted"), ("a", "第三届"): ("model", "needs_review", "accepted")}
    assert {r.model for r in made.filter("url = 'b'").collect()} == {"failed"}
