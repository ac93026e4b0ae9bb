"""From a table of documents to training sequences.

Each stage works on all that the stage before it kept, and returns the columns of documents; the last returns pieces of
packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import jaccard_join, packing, quality, secrets, suffix_dedup
from tidewell.llm.common import discard, free_name, staged, table, tune

#: Packing has no counterpart in SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, as they are. Null, empty and short texts go; rows that repeat are judged
    each for itself, to the same result; an empty table stays empty; columns of any name are kept."""
    verdict = free_name(docs, "quality")
    return quality.assess(docs, out=verdict).filter(f"{verdict}.kept").select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, one row: that with the smallest doc_id. Rows that repeat are near duplicates of
    each other. Rows without words and rows with a null doc_id stay; an empty table stays empty; columns of any name are
    kept."""
    return jaccard_join.keep_one(docs)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what long repeated strings cover. A cut through a character takes the rest of it along; a text
    that nothing is left of goes with its document. Null and empty texts stay; rows that repeat a long text lose it; an
    empty table stays empty; columns of any name are kept."""
    return suffix_dedup.cut_repeats(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in place of each secret. Null and empty texts and repeated rows stay; an empty table stays empty;
    columns of any name are kept."""
    return with_size(secrets.redact(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with checksums of their ids. A null or empty text is its end id alone; each row
    is packed for itself, a null doc_id stays null; an empty table gives no pieces; other columns don't matter."""
    return packing.digest(packing.pack(docs))


def with_size(docs: DataFrame) -> DataFrame:
    """n_chars follows the text where the table has it."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", lambda spark, docs, sf_dir: quality_rules(tune(spark), docs, sf_dir)),
    ("jaccard_join", lambda spark, docs, sf_dir: near_duplicates(tune(spark), docs, sf_dir)),
    ("suffix_dedup", lambda spark, docs, sf_dir: with_size(repeated_substrings(tune(spark), docs, sf_dir))),
    ("secret_scans", lambda spark, docs, sf_dir: secret_scans(tune(spark), docs, sf_dir)),
    ("packing", lambda spark, docs, sf_dir: sequences(tune(spark), docs, sf_dir)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, path = staged(stage(spark, docs, sf_dir), name)
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
