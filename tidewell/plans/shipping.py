"""Sends the package to the executors, so that a session started from another folder finds it there too."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once a session: the driver serves the archive, executors fetch it."""
    application = spark.sparkContext.applicationId
    if application in SENT:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    SENT.add(application)


def shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    return run
