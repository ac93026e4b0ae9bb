"""Linking texts to a catalogue of names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.facts import let
from tidewell.operators import dictionary


def link_longest(df: DataFrame, text: str, keywords: list[tuple[str, str]], out: str) -> DataFrame:
    """out: target of the longest keyword that the text holds, the earlier of equals; null if none. keywords: (keyword,
    target). The dictionary is a literal of the plan, so nothing is joined or shuffled."""
    ranked = sorted(enumerate(keywords), key=lambda x: (-len(x[1][0]), x[0]))
    return df.withColumn(out, F.coalesce(*[F.when(F.contains(F.col(text), F.lit(k)), F.lit(target)) for _, (k, target) in ranked]))


def link_unique(df: DataFrame, text: str, names: list[str], out: str) -> DataFrame:
    """out: the one name that the text holds, "ambiguous" if it holds several, "unmatched" if none."""
    held = F.array_compact(F.array(*[F.when(F.contains(F.col(text), F.lit(n)), F.lit(n)) for n in names]))
    return df.withColumn("held__", F.array_distinct(held)).withColumn(out, F.when(F.size("held__") == 1, F.col("held__")[0]).when(F.size("held__") > 1, "ambiguous").otherwise("unmatched")).drop("held__")


def contained_passages(df: DataFrame, key: str, text: str, passages: DataFrame, passage: str, seed: int = 4) -> DataFrame:
    """Pairs of a row of df (columns key and text) and a passage that its text holds as it is.

    The words of a passage but its first and last are whole words of a text that holds it, so the first `seed` of them
    are looked up by their hash among the runs of words of all texts; only (key, hash) travels until a text is compared
    in full. Passages of fewer than seed + 2 words are looked up by their rarest run of characters. A null or empty passage
    says nothing and is held by no text."""
    spaces = r"[\x20\x09-\x0D]+"
    inner = F.slice(F.split(passage, spaces), 2, seed)
    long_enough = F.size(F.split(passage, spaces)) >= seed + 2
    seeds = passages.filter(long_enough).withColumn("seed__", F.xxhash64(F.array_join(inner, " ")))
    # Each word's place is hashed with those behind it: one array a position, shifted, so that no slice is copied.
    runs = let(F.split(text, spaces), lambda w: F.transform(w, lambda x, i: F.xxhash64(F.concat_ws(" ", x, *[F.get(w, i + k) for k in range(1, seed)]))))
    df = df.select(key, text)
    held = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("key__"), F.explode(F.array_distinct(runs)).alias("seed__")).join(seeds, "seed__").distinct()
    found = df.join(held, F.col(key).eqNullSafe(F.col("key__")) & F.contains(F.col(text), F.col(passage))).select(*df.columns, *passages.columns)
    short = passages.filter(F.size(F.split(passage, spaces)) < seed + 2)
    # JSON names each key, a null one too.
    named = df.withColumn("json__", F.to_json(F.struct(F.col(key).alias("k"))))
    pairs = dictionary.occurrences(named, "json__", text, short, passage)
    more = named.join(pairs, F.col("json__") == F.col("key")).drop("json__", "key").join(short, F.col("name") == F.col(passage))
    return found.unionByName(more.select(*df.columns, *passages.columns))
