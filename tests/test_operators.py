import datetime
import itertools
import json
import random

import numpy as np
from pyspark.sql import functions as F

from tidewell.functions import dates, facts, text
from tidewell.operators import calendar, history, layout, linking
from tidewell.plans.catalogue import QUERIES
from tidewell.sources import readers, sinks
from tidewell.streaming.upserts import compact, newest, upsert_stream


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_text(spark):
    row = one(
        spark, text.half_width(F.lit("ＡＢ１　x")), text.match_score(F.lit("Robot-Design, 2026!"), F.lit("robot design")), text.match_score(F.lit("robot design"), F.lit("rtd")),
        text.match_score(F.lit("abc"), F.lit("x")), text.match_score(F.lit("abc"), F.lit("")), text.title_key(F.lit("[转] A “b” c")), text.despace_cjk(F.lit("报 名 表 a b")),
        text.clean_tags(F.lit("<b>a</b> &amp;amp; b&nbsp; c")), text.excerpt(F.lit("aaaa。bbbbbbbb"), 10, least=0.4), text.excerpt(F.lit("aaaa。bbbbbbbb"), 10),
    )
    assert tuple(row) == ("AB1 x", 2, 1, 0, 2, "Abc", "报名表 a b", "a &amp; b c", "aaaa。", "aaaa。bbbbb…")


def test_absolute_url(spark):
    base = F.lit("https://example.edu/a/b.htm?x=1")
    links = ["c.htm", "/c", "//h/c", "http://h/c", "mailto:x@y", "javascript:void(0)"]
    got = one(spark, *[text.absolute_url(base, F.lit(x)) for x in links])
    assert tuple(got) == ("https://example.edu/a/c.htm", "https://example.edu/c", "https://h/c", "http://h/c", "", "")


def test_date_events(spark):
    texts = spark.createDataFrame([("报名截止：1月5日。提交2026年12月25日，2026年2月30日", "2026-12-10")], "t string, d string")
    made = facts.date_events(texts, "t", "d", "e").first().e
    assert [(e.value, e.raw, e.start, e.end, list(e.flags)) for e in made] == [
        ("2026-01-05", "1月5日", 5, 9, ["missing_year", "before_publication", "possible_cross_year"]), ("2026-12-25", "2026年12月25日", 12, 23, []), (None, "2026年2月30日", 24, 34, ["invalid_date"]),
    ]


def test_clock_and_instant(spark):
    got = one(spark, dates.clock(F.lit(3), F.lit(30), F.lit("pm")), dates.clock(F.lit(24), F.lit(0), F.lit(None)), dates.clock(F.lit(25), F.lit(61), F.lit(None)), dates.instant(F.to_date(F.lit("2026-11-25")), F.lit("24:00"), F.lit(False)), dates.instant(F.to_date(F.lit("2026-11-25")), F.lit(None).cast("string"), F.lit(False)))
    assert tuple(got) == ("15:30", "24:00", None, datetime.datetime(2026, 11, 26), datetime.datetime(2026, 11, 25, 23, 59, 59))


def test_status(spark):
    now = F.lit("2026-10-04")
    cases = [("2026-11-01", "2026-12-01", "not_started"), ("2026-09-01", "2026-12-01", "open"), ("2026-09-01", "2026-09-30", "closed"), (None, None, "unknown")]
    got = spark.createDataFrame([c[:2] for c in cases], "s string, d string").select(history.registration_status(F.col("s"), F.col("d"), now).alias("x")).collect()
    assert [r.x for r in got] == [c[2] for c in cases]


def test_partition_is_best():
    rng = random.Random(4)
    for _ in range(60):
        n, k = rng.randint(3, 8), rng.randint(2, 3)
        values, centres = np.array([rng.random() * 10 for _ in range(n)]), np.array(sorted(rng.random() * 10 for _ in range(k)))
        got = layout.monotone_partition(values[None, :], centres)[0]
        cost = lambda part: sum(abs(values[part == g].mean() - c) for g, c in enumerate(centres))
        best = min(cost(np.repeat(range(k), np.diff([0, *cut, n]))) for cut in itertools.combinations(range(1, n), k - 1))
        assert sorted(set(got.tolist())) == list(range(k)) and (np.diff(got) >= 0).all() and abs(cost(got) - best) < 1e-9


def test_fold():
    for line in ("a" * 200, "é" * 100, "报名" * 60, "", "x" * 75):
        parts = layout.fold(line).split("\r\n")
        assert all(len(p.encode()) <= 75 for p in parts)
        assert parts[0] + "".join(p[1:] for p in parts[1:]) == line


def test_links(spark):
    df = spark.createDataFrame([("alpha beta",), ("beta",), ("none",)], "t string")
    assert [r.x for r in linking.link_unique(df, "t", ["alpha", "beta"], "x").collect()] == ["ambiguous", "beta", "unmatched"]
    assert [r.x for r in linking.link_longest(df, "t", [("beta", "B"), ("alpha beta", "AB")], "x").collect()] == ["AB", "B", None]


def test_calendar(spark):
    got = one(spark, calendar.event(F.lit("h1"), F.lit("20260101"), F.lit("a, b; c\\d"), F.lit(None).cast("string")))[0]
    assert got.split("\r\n") == ["BEGIN:VEVENT", "UID:h1", "DTSTART;VALUE=DATE:20260101", "RRULE:FREQ=YEARLY", "SUMMARY:a\\, b\\; c\\\\d", "END:VEVENT"]


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b|c'), (2, None)], "id int, name string").coalesce(1)
    at = lambda name: f"file://{tmp_path}/{name}"
    sinks.envelope(df, at("e.json"), "made up")
    assert sorted(readers.envelope(spark, at("e.json"), df.schema).collect()) == sorted(df.collect())
    assert readers.envelope(spark, at("missing.json"), df.schema).count() == 0
    sinks.csv_document(df, at("t.csv"))
    assert (tmp_path / "t.csv").read_bytes().startswith(b"\xef\xbb\xbfid,name\r\n")
    assert [tuple(r) for r in readers.csv_table(spark, at("t.csv"), ["id", "name"]).collect()] == [("1", 'a "q", b|c'), ("2", "")]
    sinks.markdown(df, at("t.md"), "T")
    assert "b\\|c" in (tmp_path / "t.md").read_text()
    sinks.script_bundle({"t": df}, at("d.js"))
    assert (tmp_path / "d.js").read_text().startswith('window.SITE_DATA = {"t":[{"id":1')
    sinks.calendar_file(spark.createDataFrame([("BEGIN:VEVENT\r\nEND:VEVENT",)], "e string"), "e", at("c.ics"), "-//x//", "n")
    assert (tmp_path / "c.ics").read_bytes().endswith(b"END:VEVENT\r\nEND:VCALENDAR\r\n")
    many = spark.range(20_000).select("id", F.lit("x|y").alias("name")).repartitionByRange(5, "id").sortWithinPartitions("id")
    sinks.envelope(many, at("m.json"), "many")
    whole = json.loads((tmp_path / "m.json").read_text())
    assert whole["count"] == 20_000 and [i["id"] for i in whole["items"]] == list(range(20_000))
    sinks.envelope(many.limit(0), at("none.json"), "none")
    assert json.loads((tmp_path / "none.json").read_text()) == {"source": "none", "schema_version": 1, "count": 0, "items": []}
    sinks.markdown(many, at("m.md"), "T")
    assert (tmp_path / "m.md").read_text().splitlines()[4:6] == ["| 0 | x\\|y |", "| 1 | x\\|y |"] and len((tmp_path / "m.md").read_text().splitlines()) == 20_004
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == sorted(["e.json", "t.csv", "t.md", "d.js", "c.ics", "m.json", "none.json", "m.md"])
    (tmp_path / "u.txt").write_text("# urls\n\nhttps://example.edu/a\nhttps://example.edu/b\nhttps://example.edu/a\n")
    assert [r.url[-1] for r in readers.url_list(spark, at("u.txt")).collect()] == ["a", "b"]
    (tmp_path / "x.pdf").write_bytes(b"%PDF-1.4")
    assert readers.blobs(spark, at("x.pdf")).first().kind == "pdf"


def test_assets(spark):
    df = spark.createDataFrame([("n", ["u", "v"], ["v", "w"]), ("m", None, None)], "k string, a array<string>, i array<string>")
    assert sorted((r.url, r.kind) for r in readers.assets(df, "k", "a", "i").collect()) == [("u", "attachment"), ("v", "attachment"), ("w", "image")]


def test_upsert_stream(spark, tmp_path):
    schema = "id long, name string"
    source, folder = tmp_path / "in", f"file://{tmp_path}/table"
    for k, rows in enumerate(([(1, "a"), (2, "b")], [(2, "c"), (3, "d")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        upsert_stream(stream, "id", folder, f"file://{tmp_path}/progress").awaitTermination()
        assert newest(spark, folder, stream.schema).count() == 2 + k
    assert sorted(tuple(r) for r in newest(spark, folder, stream.schema).collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_upserts_do_not_hang_on_order(spark, tmp_path):
    kinds = "id long, at int, name string, note string"
    rows = [(1, 1, "a", "x"), (1, 3, "c", None), (1, 2, "b", "y"), (2, 1, "p", None), (2, 1, "q", None)]
    for k, data in enumerate((rows, rows[::-1])):
        source, folder = tmp_path / f"in{k}", f"file://{tmp_path}/table{k}"
        spark.createDataFrame(data, kinds).repartition(3).write.parquet(str(source))
        stream = spark.readStream.schema(kinds).parquet(str(source))
        upsert_stream(stream, "id", folder, f"file://{tmp_path}/progress{k}", "at").awaitTermination()
        assert sorted(tuple(r) for r in newest(spark, folder, stream.schema).collect()) == [(1, 3, "c", "y"), (2, 1, "q", None)]
    assert compact(spark, folder, stream.schema, folder + "-small") == 0
    assert newest(spark, folder + "-small", stream.schema).count() == 2


def test_a_document_is_replaced_in_one_step(spark, tmp_path):
    for text in ("old", "new"):
        sinks.write_text(spark, f"file://{tmp_path}/d.txt", text)
        assert (tmp_path / "d.txt").read_text() == text and not (tmp_path / "d.txt.part").exists()
        assert spark.read.text(f"file://{tmp_path}/d.txt").first().value == text


def fixture(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_passages_are_whole(spark, tmp_path):
    passage = "An opening that is longer than sixty characters, as most are. " + "Then comes a second sentence, and a third one to end with."
    texts = [f"x {passage} y", passage[:70] + " and another end", passage[62:], passage, None, ""]
    at = fixture(spark, tmp_path, documents=(list(enumerate(texts)), "doc_id long, text string"), benchmark=([(7, passage), (8, "no such"), (9, None)], "item_id long, text string"))
    assert sorted(tuple(r) for r in QUERIES["q29_passage_containment"](spark, at).select("doc_id", "item_id").collect()) == [(0, 7), (3, 7)]


def test_whole_texts_are_normalised(spark, tmp_path):
    texts = ["ＡＢ１　x", "x" * 60 + "ＡＢ１　！" + "y" * 60 + "～", "", None]
    at = fixture(spark, tmp_path, documents=(list(enumerate(texts)), "doc_id long, text string"))
    got = [r.head for r in QUERIES["q10_fullwidth_normalise"](spark, at).orderBy("doc_id").collect()]
    assert got == ["AB1 x", "x" * 60 + "AB1 !" + "y" * 60 + "~", "", None]


def test_all_customers_are_in_the_union(spark, tmp_path):
    customers = [(1, "Customer#01"), (2, "Customer#02"), (3, "Customer#03")]
    suppliers, nations = [(1, "Supplier #01"), (9, "Supplier #09")], [(0, "customer #02"), (1, "PERU")]
    at = fixture(spark, tmp_path, customer=(customers, "c_custkey long, c_name string"), supplier=(suppliers, "s_suppkey long, s_name string"), nation=(nations, "n_nationkey int, n_name string"))
    got = sorted((r.name_key, r.name, r.origin) for r in QUERIES["q24_priority_union"](spark, at).collect())
    assert got == [("customer#01", "Customer#01", "customer"), ("customer#02", "Customer#02", "customer"), ("customer#03", "Customer#03", "customer"), ("customer#09", "customer #09", "supplier"), ("peru", "PERU", "nation")]
