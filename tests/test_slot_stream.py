import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators import editions, notices
from tidewell.streaming import slots

NOTICES = [
    ("u1", "2026-03-01", "报名截止：2026年3月20日。"),
    ("u2", "2026-03-15", "原报名截止2026年3月20日，现延期至2026年4月10日。"),
    ("u3", "2026-03-20", "报名截止延期至2026年5月1日。"),
    ("u4", "2026-04-01", "作品提交截至2026年6月10日"),
    ("u5", "2026-02-01", "报名截止：2026年3月20日。"),
]


@pytest.fixture(scope="module")
def placed(spark):
    docs = spark.createDataFrame(NOTICES, "url string, date string, body string")
    none = F.lit(None).cast("string")
    about = docs.select("url", "date", F.lit("robot").alias("competition"), F.lit("e1").alias("edition_id"), none.alias("phase"), none.alias("stage"))
    return about, notices.events(docs, "url", "body", "date")


def test_same_slots_in_any_order(spark, placed, tmp_path):
    want = {r.kind: r.asDict(True) for r in editions.slots(*placed).collect()}
    assert want["registration_deadline"]["applied"] == 2
    sent = slots.messages(editions.placed(*placed), F.to_timestamp(F.col("event.date"))).collect()
    kind = editions.placed(*placed).schema["event"].dataType.simpleString()
    for turn in range(2):
        order = sent * 2
        random.Random(turn).shuffle(order)
        source, out = tmp_path / f"in{turn}", tmp_path / f"out{turn}"
        schema = "slot string, place string, event string, due timestamp, seen timestamp"
        for i in range(0, len(order), 5):
            spark.createDataFrame(order[i : i + 5], schema).coalesce(1).write.mode("append").parquet(str(source))
        clock = [("clock", None, None, None, F.to_timestamp(F.lit("2026-05-02")))]
        spark.range(1).select(F.lit("clock").alias("slot"), F.lit(None).cast("string").alias("place"), F.lit(None).cast("string").alias("event"), F.lit(None).cast("timestamp").alias("due"), clock[0][4].alias("seen")).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        slots.tell(spark, slots.slot_stream(stream, "120 days"), str(out), str(tmp_path / f"c{turn}")).awaitTermination()
        told = spark.read.parquet(str(out))
        newest = told.filter("why = 'changed'").groupBy("slot").agg(F.max_by(F.struct("why", "at", "events"), "delta").alias("x")).select("slot", "x.*")
        got = {r.kind: r.asDict(True) for r in slots.read_slots(newest, kind).drop("why", "at").collect()}
        assert got == want


def test_clock(spark, placed, tmp_path):
    sent = slots.messages(editions.placed(*placed), F.to_timestamp(F.col("event.date")))
    schema = "slot string, place string, event string, due timestamp, seen timestamp"
    source, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c")

    def tick(day):
        spark.sql(f"SELECT 'clock' AS slot, CAST(NULL AS STRING) AS place, CAST(NULL AS STRING) AS event, CAST(NULL AS TIMESTAMP) AS due, TIMESTAMP '{day}' AS seen").write.mode("append").parquet(source)
        run()

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        slots.tell(spark, slots.slot_stream(stream, keep_days=30), out, check).awaitTermination()

    sent.write.parquet(source)
    run()
    for day in ("2026-04-12", "2026-07-01", "2026-09-01"):
        tick(day)
    rows = [(r.why, str(r.at.date()), len(r.events)) for r in spark.read.parquet(out).filter("slot like '%registration_deadline%'").orderBy("at").collect()]
    assert rows[0][0] == "changed" and ("due", "2026-04-10", rows[0][2]) in rows and ("due", "2026-05-01", rows[0][2]) in rows and rows[-1][:2] == ("forgotten", "2026-05-31")
