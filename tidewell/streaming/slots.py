"""The dates of editions as a stream: each slot's events are kept in their own order, whatever order they come in.

What a slot comes to hangs on the order of its notices, so late notices aren't dropped: they take their place among the
earlier ones, and the slot is told anew, by the same fold as in batch. The clock is the watermark: a slot is told again
when a date of it has passed, and forgotten when nothing was heard of it for long.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewell.operators import editions

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TOLD = "slot string, why string, at timestamp, events array<string>"


def messages(placed: DataFrame, seen: Column) -> DataFrame:
    """Stream rows of editions.placed rows: slot (JSON), place (digest of the event), event (JSON), due (when its date has
    passed, null if it has none), seen (event time)."""
    e = F.col("event")
    due = editions.event_instant(e["value"], e["time"], F.col("kind").endswith("_start")).cast("timestamp")
    return placed.select(
        F.to_json(F.struct(*editions.SLOT)).alias("slot"), F.sha2(F.to_json(e), 256).alias("place"), F.to_json(e).alias("event"), due.alias("due"), seen.alias("seen"),
    )


class Slot(StatefulProcessor):
    """keep_ms: how long a slot stays after the last of its dates and messages."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getMapState("events", "place string", "event string")
        self.last = handle.getValueState("last", "ms long")

    def told(self, key: tuple, why: str, ms: int) -> Row:
        return Row(slot=key[0], why=why, at=_timestamp(ms), events=[v[0] for _, v in self.events.iterator()])

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now, news, last = timerValues.getCurrentWatermarkInMs(), False, self.last.get()[0] if self.last.exists() else 0
        for row in rows:
            if row.event is None or self.events.containsKey((row.place,)):
                continue
            self.events.updateValue((row.place,), (row.event,))
            news, seen = True, int(row.seen.timestamp() * 1000)
            due = int(row.due.timestamp() * 1000) if row.due is not None else 0
            if due > now:
                self.handle.registerTimer(due)
            last = max(last, seen, due)
        if news:
            self.last.update((last,))
            self.handle.registerTimer(last + self.keep_ms)
            yield self.told(key, "changed", now)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        ms = expiredTimerInfo.getExpiryTimeInMs()
        if self.last.exists():
            if ms >= self.last.get()[0] + self.keep_ms:
                yield self.told(key, "forgotten", ms)
                self.events.clear()
                self.last.clear()
            elif ms <= self.last.get()[0]:
                yield self.told(key, "due", ms)

    def close(self) -> None:
        pass


def _timestamp(ms: int):
    import datetime

    return datetime.datetime.fromtimestamp(ms / 1000)


def slot_stream(stream: DataFrame, late: str = "0 seconds", keep_days: int = 400) -> DataFrame:
    """slot, why (changed, due or forgotten), at, events: what is told of slots, of a stream of messages. A message that was
    there already tells nothing; one without an event only moves the clock."""
    processor = Slot(keep_days * 86_400_000)
    return stream.withWatermark("seen", late).groupBy("slot").transformWithState(processor, TOLD, "Update", "EventTime")


def read_slots(told: DataFrame, event_type: str) -> DataFrame:
    """Slots (as editions.slots gives them, with why and at) of rows that slot_stream told; event_type: that of placed rows'
    event, as its schema's simpleString."""
    names = {"competition": "string", "edition_id": "string", "kind": "string", "track": "string", "phase": "string", "stage": "string"}
    slot = F.from_json("slot", ", ".join(f"{n} {t}" for n, t in names.items()))
    events = F.sort_array(F.transform("events", lambda x: F.from_json(x, event_type)))
    gathered = told.select("why", "at", slot.alias("s"), events.alias("events")).select("why", "at", *[F.col(f"s.{n}").alias(n) for n in editions.SLOT], "events")
    return editions.folded(gathered)


def tell(spark: SparkSession, told: DataFrame, folder: str, checkpoint: str):
    """Each micro-batch becomes the delta of its number (see upserts), told slots as they are; run until what is there is
    read."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/delta={number}")

    return told.writeStream.foreachBatch(land).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
