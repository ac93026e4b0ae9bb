from pyspark.sql import functions as F

from tidewell.operators import scanned
from tidewell.sources import content

PAGE = """<html><body><nav>menu</nav><div class="v_news_content x"><p>First <b>one</b></p><div>loose<table><tr><th>h</th><td colspan="2">c</td></tr></table></div>
<p>扫码进QQ群</p><p><img src="q.png" alt="q"></p><a href="f.pdf">附件</a><a href="/enroll">here</a><a href="#top">top</a><a href="n.htm">下一篇</a><a href="f.pdf">表格</a></div></body></html>"""


def test_articles(spark):
    pages = spark.createDataFrame([("http://a.example/d/x.htm", PAGE), ("http://b.example/", PAGE), ("http://c.example/", None)], "url string, html string")
    got = {r.url[7]: r for r in content.articles(pages, {"": [("class", "v_news_content")], "b.example": [("id", "none")]}).collect()}
    a = got["a"]
    assert a.status == "success" and list(a.paragraphs) == ["First one", "loose", "扫码进QQ群", "附件", "here", "top", "下一篇", "表格"] and [(b["type"], b["index"]) for b in a.blocks][:3] == [("paragraph", 0), ("paragraph", 1), ("table", 0)]
    assert [[(c.text, c.colspan, c.header) for c in row] for row in a.tables[0]] == [[("h", "1", True), ("c", "2", False)]]
    assert [(i.url, i.context) for i in a.images] == [("http://a.example/d/q.png", "扫码进QQ群")]
    assert [(x.url, x.text, x.kind) for x in a.links] == [("http://a.example/enroll", "here", "form"), ("http://a.example/d/f.pdf", "表格", "file")]
    assert got["b"].status == got["c"].status == "failed" and len(a.content_hash) == 64


def test_scans(spark):
    words = spark.createDataFrame([(1, 1, "报", 90.0), (1, 2, "名", 60.0), (1, 3, " ", 95.0), (2, 1, "a", -1.0), (2, 2, "b", 80.0)], "line int, n int, w string, c double")
    assert sorted((r.line, r.text, r.certainty) for r in scanned.lines_of_words(words, ["line"], "n", "w", "c").collect()) == [(1, "报名", 60.0), (2, "b", 80.0)]
    lines = scanned.cleaned(spark.createDataFrame([(0, " 教 务 处 https：//jw.a.edu/cn "), (1, ""), (2, "HTTPS://JW.A.EDU.CN"), (3, "www.b.edu.cn x")], "line_no int, line string"))
    found = scanned.address_candidates(lines)
    assert sorted(r.candidate for r in found.collect()) == ["https://jw.a.edu.cn", "www.b.edu.cn"]
    assert {r.domain: r.n for r in scanned.domain_counts(found, r"(?i)([a-z0-9.-]*\.edu\.cn)").collect()} == {"jw.a.edu.cn": 1, "www.b.edu.cn": 1}
    probes = spark.createDataFrame([("s", "http://s.a/", "200"), ("s", "https://s.a/", "ERR:x"), ("t", "http://t.a/", "200"), ("t", "https://t.a/", "403")], "sub string, url string, status string")
    assert {r.sub: r.url for r in scanned.best_site(probes).collect()} == {"s": "http://s.a/", "t": "https://t.a/"}
    links = spark.createDataFrame([("d", 0, "http://x/", "首页"), ("d", 1, "http://all/", "a"), ("d", 2, "http://d/", "学院"), ("e", 0, "http://all/", "a"), ("f", 0, "http://all/", "a")], "department string, pos int, href string, label string")
    assert {r.department: r.homepage for r in scanned.homepages(links).collect()} == {"d": "http://d/", "e": None, "f": None}
    rows = spark.createDataFrame([("", "x", "7"), ("u", "a", "z"), ("v", "a", "1")], "url string, kind string, n string")
    assert [list(r.errors) for r in scanned.shape_errors(rows, {"url": "string", "n": "int"}, {"kind": ["a"]}).collect()] == [["missing url", "value kind"], ["type n"], []]
    states = spark.createDataFrame([(None, "t", "d", "a"), ("x 验证", "t", "d", "a"), ("x", "", "d", "a"), ("x", "t", "", "a"), ("x", "t", "d", "a")], "h string, t string, d string, a string")
    assert [r.s for r in states.select(scanned.article_state(*map(F.col, "htda")).alias("s")).collect()] == ["empty", "blocked", "no_title", "incomplete", "ok"]
