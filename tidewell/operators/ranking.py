"""Places in a total order over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.operators import rounds


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str = "place") -> DataFrame:
    """keys and `name`: the place, from 1, of each row in the order, which must be total. Rows are sorted over ranges and
    counted within each; only the ranges' sizes are summed up in one task."""
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    nth = F.monotonically_increasing_id()
    rows, _ = rounds.kept(sorted_.select(*keys, F.shiftright(nth, 33).alias("range__"), nth.bitwiseAND(F.lit((1 << 33) - 1)).alias("nth__")), "ranges")
    before = Window.orderBy("range__").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("range__").agg(F.count("*").alias("n")).select("range__", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start__"))
    return rows.join(starts, "range__").select(*keys, (F.col("start__") + F.col("nth__") + 1).alias(name))
