"""Connected components by alternating stars, as joins and aggregations over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import discard, staged


def components(edges: DataFrame) -> tuple[DataFrame, str]:
    """edges (u long, v long), in any direction and number -> (node, component): the smallest node it reaches, for each
    node of an edge that isn't the smallest of its component itself. Also the path of that table.

    In a large-star step each node's larger neighbours are tied to the smallest node that it knows, in a small-star
    step its smaller ones; the forest is flat when a round changes nothing, after some log(n) rounds.
    """
    spark = edges.sparkSession
    now, path = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    stamp = lambda df: df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
    before = stamp(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(lower, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        made, made_path = staged(tied.unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(spark, path)
        now, path, after = made, made_path, stamp(made)
        if tuple(after) == tuple(before):
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")), path
