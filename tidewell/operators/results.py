"""Results that are kept from run to run: what was worked out for a key counts until its content, the version of the
program or its configuration changes.

A store is a folder: `run=<id>` folders of rows, and snapshots, small files that name the runs which count. A snapshot is
written beside its place and renamed to the next number, which fails where another writer was first; what a run wrote
without getting its snapshot is never read. So readers see whole runs, and a run that died changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a result hangs on, and what is known of how it was found.
KEYS = ("key", "content", "version", "config")
META = "key string, content string, version string, config string, status string, error string, at timestamp, run string"


class Conflict(RuntimeError):
    """Another writer committed a snapshot in between: run again on what it left."""


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


class Store:
    """folder: in a file system that all executors share. kind: schema of a result, as the column `result`."""

    def __init__(self, spark: SparkSession, folder: str, kind: str):
        self.spark, self.folder, self.kind = spark, folder.rstrip("/"), kind
        self.schema = spark.createDataFrame([], f"{META}, result {kind}").schema

    def snapshot(self) -> tuple[int, list[str]]:
        """Number of the newest snapshot (0: none) and its runs, oldest first."""
        where, fs = _fs(self.spark, f"{self.folder}/snapshots")
        names = [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []
        newest = max((int(n) for n in names if n.isdigit()), default=0)
        if not newest:
            return 0, []
        stream = fs.open(_fs(self.spark, f"{self.folder}/snapshots/{newest}")[0])
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return newest, json.loads(text)["runs"]

    def rows(self) -> DataFrame:
        """All rows of the runs that count."""
        runs = self.snapshot()[1]
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/run={r}" for r in runs]) if runs else self.spark.createDataFrame([], self.schema)

    def newest(self) -> DataFrame:
        """One row for each of KEYS: the last that was written; a failure doesn't take the place of a success."""
        order = F.struct(F.col("status") == "success", "at", "run")
        whole = F.struct(*[c for c in self.schema.fieldNames() if c not in KEYS])
        return self.rows().groupBy(*KEYS).agg(F.max_by(whole, order).alias("r")).select(*KEYS, "r.*").select(*self.schema.fieldNames())

    def commit(self, seen: int, runs: list[str]) -> int:
        """Makes these runs the snapshot after `seen`."""
        made, fs = _fs(self.spark, f"{self.folder}/snapshots/.{uuid.uuid4().hex}")
        out = fs.create(made, False)
        out.write(json.dumps({"runs": runs}).encode())
        out.close()
        to = _fs(self.spark, f"{self.folder}/snapshots/{seen + 1}")[0]
        if fs.exists(to) or not fs.rename(made, to):
            fs.delete(made, False)
            raise Conflict(f"snapshot {seen + 1} is there already")
        return seen + 1

    def pending(self, inputs: DataFrame, version: str, config: str, now: Column, rest_hours: int = 24) -> DataFrame:
        """inputs (key, content, ..) that no result counts for: none that succeeded with this content, version and
        configuration, and none that failed with them in the last hours."""
        fine = (F.col("status") == "success") | (F.col("at") > now - F.make_dt_interval(hours=F.lit(rest_hours)))
        done = self.rows().filter((F.col("version") == version) & (F.col("config") == config) & fine).select("key", "content").distinct()
        return inputs.join(done, ["key", "content"], "left_anti")

    def refresh(self, inputs: DataFrame, compute: Callable[[DataFrame], DataFrame], version: str, config: str = "", now: Column | None = None, rest_hours: int = 24) -> int:
        """Works out what is pending and commits it as one run; returns the number of inputs that it touched.

        inputs: key (unique), content (a digest of what the result hangs on) and what compute needs. compute: rows of
        inputs -> key, result, error (null where it went well); a key that it leaves out has failed. Inputs with a null key
        or content are left alone. Nothing is written where nothing is pending."""
        now = F.current_timestamp() if now is None else now
        seen, runs = self.snapshot()
        todo = self.pending(inputs.filter("key is not null and content is not null"), version, config, now, rest_hours)
        if todo.isEmpty():
            return 0
        run = uuid.uuid4().hex
        made = compute(todo).select("key", "result", "error").withColumn("made__", F.lit(True))
        status = F.when(F.col("made__") & F.col("error").isNull(), "success").otherwise("failed")
        rows = todo.select("key", "content").join(made, "key", "left").select(
            "key", "content", F.lit(version).alias("version"), F.lit(config).alias("config"), status.alias("status"), F.when(status == "failed", F.coalesce("error", F.lit("no result"))).alias("error"),
            now.cast("timestamp").alias("at"), F.lit(run).alias("run"), F.when(status == "success", F.col("result")).alias("result"),
        )
        rows.write.parquet(f"{self.folder}/run={run}")
        self.commit(seen, [*runs, run])
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/run={run}").count()

    def current(self, inputs: DataFrame, version: str, config: str = "") -> DataFrame:
        """inputs (key, content, ..) with state, result and run: fresh (as they are now), stale (the last success of the key
        with another content, version or configuration), failed or pending (neither, without a result)."""
        rows = self.newest()
        now = rows.filter((F.col("version") == version) & (F.col("config") == config)).select("key", "content", F.struct("status", "result", "run").alias("now__"))
        last = rows.filter("status = 'success'").groupBy("key").agg(F.max_by(F.struct("result", "run"), F.struct("at", "run")).alias("last__"))
        joined = inputs.join(now, ["key", "content"], "left").join(last, "key", "left")
        fresh, there = F.coalesce(F.col("now__.status") == "success", F.lit(False)), F.col("last__").isNotNull()
        state = F.when(fresh, "fresh").when(there, "stale").when(F.col("now__").isNotNull(), "failed").otherwise("pending")
        pick = lambda c: F.when(fresh, F.col(f"now__.{c}")).otherwise(F.col(f"last__.{c}")).alias(c)
        return joined.select(*[c for c in inputs.columns], state.alias("state"), pick("result"), pick("run"))

    def compact(self) -> int:
        """Rewrites what counts as one run, and drops the folders of runs that no snapshot but old ones name."""
        seen, runs = self.snapshot()
        if len(runs) < 2:
            return seen
        run = uuid.uuid4().hex
        self.newest().write.parquet(f"{self.folder}/run={run}")
        number = self.commit(seen, [run])
        for old in runs:
            where, fs = _fs(self.spark, f"{self.folder}/run={old}")
            fs.delete(where, True)
        return number
