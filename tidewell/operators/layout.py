"""Layout: ordered fragments to groups, and lines folded by bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window


#: Rows of more values are partitioned one by one; ends of their groups are looked for so many at a time, and so many of
#: them are followed to find a bound.
LONG, FEW = 64, 16


def monotone_partition(values: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Groups (rows x n) of the ordered values (rows x n): contiguous runs, in order and none empty, one for each of k
    centres, with the least sum over the groups of the distance of a group's mean to its centre; of equals the one
    whose later groups begin earlier. Rows with fewer values than centres take one group each, in order."""
    rows, n = values.shape
    k = centres.shape[-1]
    if n <= k or not k:
        return np.broadcast_to(np.arange(n), (rows, n)).astype(np.int64)
    centres = np.broadcast_to(centres, (rows, k))
    if n > LONG and np.isfinite(values).all() and np.isfinite(centres).all():
        return np.stack([long_partition(v, c) for v, c in zip(values, centres, strict=True)])
    total = np.concatenate([np.zeros((rows, 1)), np.cumsum(values, axis=1)], axis=1)
    best = np.full((rows, n + 1), np.inf)
    best[:, 0] = 0.0
    start = np.zeros((k, rows, n + 1), np.int64)
    for g in range(k):
        after = np.full((rows, n + 1), np.inf)
        for i in range(g + 1, n + 1):  # the group g ends behind value i - 1 and begins at j
            j = np.arange(g, i)
            cost = best[:, j] + np.abs((total[:, [i]] - total[:, j]) / (i - j) - centres[:, [g]])
            at = np.argmin(cost, axis=1)
            start[g, :, i] = j[at]
            after[:, i] = cost[np.arange(rows), at]
        best = after
    out = np.zeros((rows, n), np.int64)
    end = np.full(rows, n)
    place = np.arange(n)
    for g in range(k - 1, -1, -1):
        begin = start[g, np.arange(rows), end]
        out[(place >= begin[:, None]) & (place < end[:, None])] = g
        end = begin
    return out


def long_partition(values: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """monotone_partition of one row of finite numbers, with fewer centres than values. A way that follows the best few
    ends of each group gives a bound; as distances only add up, what already costs more is no part of the best way, and
    of all else nothing is left out. Where values fall or rise, so do the means of groups that begin at one place, and
    ends are looked for as far as these can come near the centre."""
    n, k = len(values), len(centres)
    total = np.concatenate([[0.0], np.cumsum(values)])
    steps = np.diff(values)
    sense = -1 if (steps <= 0).all() else 1 if (steps >= 0).all() else 0
    error = 8 * n * np.finfo(float).eps * max(np.abs(values).sum(), np.abs(centres).max())  # more than means are off by
    _, bound = ways(total, centres, np.inf, sense, error, FEW)
    found, _ = ways(total, centres, bound, sense, error)
    out, end = np.zeros(n, np.int64), n
    for g in range(k - 1, -1, -1):
        ends, begins = found[g]
        begin = int(begins[np.searchsorted(ends, end)])
        out[begin:end] = g
        end = begin
    return out


def ways(total: np.ndarray, centres: np.ndarray, bound: float, sense: int, error: float, most: int | None = None) -> tuple[list[tuple[np.ndarray, np.ndarray]], float]:
    """For each group the ends that are reached within the bound, and the best beginning for each; and what the best way to
    the last value costs. most: only so many ends of a group, those of least cost, are followed."""
    n, k = len(total) - 1, len(centres)
    at, cost = np.array([0]), np.array([0.0])
    found = []
    for g in range(k):
        first, last = (n, n) if g == k - 1 else (int(at[0]) + 1, n - (k - 1 - g))
        ends, begins, costs = [], [], []
        for low in range(first, last + 1, LONG):
            i = np.arange(low, min(low + LONG, last + 1))
            size = i - at[:, None]
            off = (total[i] - total[at][:, None]) / np.maximum(size, 1) - centres[g]
            each = np.where(size > 0, cost[:, None] + np.abs(off), np.inf)
            best = np.argmin(each, axis=0)
            least = each[best, np.arange(len(i))]
            near = np.isfinite(least) & (least <= bound)
            ends.append(i[near])
            begins.append(at[best[near]])
            costs.append(least[near])
            if sense and size[-1, -1] > 0 and (sense * off[:, -1] > (error if most else bound - cost + error)).all():
                break
        at, begun, cost = np.concatenate(ends), np.concatenate(begins), np.concatenate(costs)
        if most and len(at) > most:
            few = np.sort(np.argpartition(cost, most)[:most])
            at, begun, cost = at[few], begun[few], cost[few]
        found.append((at.astype(np.int32), begun.astype(np.int32)))
    return found, float(cost[-1])


def partition_arrays(values: Column, centres: list[float]) -> Column:
    """array<long>: the group of each of a row's ordered values. Rows of one length are worked out together."""
    fixed = np.array(centres)

    @F.pandas_udf("array<long>")
    def parts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            lengths = column.map(len).to_numpy()
            out = np.empty(len(column), object)
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                step = max(1, (1 << 22) // max(1, int(n)))
                for i in range(0, len(at), step):
                    some = at[i : i + step]
                    made = monotone_partition(np.stack(column.iloc[some].to_list()).reshape(len(some), n).astype(float), fixed)
                    for row, groups in zip(some, made, strict=True):
                        out[row] = groups
            yield pd.Series(out, index=column.index)

    return parts(values)


def partition_rows(df: DataFrame, key: str, order: str, value: str, centres: list[float]) -> DataFrame:
    """key, order, value, part: monotone_partition of each key's rows by order. A key's rows meet in one array, as they
    are the fragments of one page or column; rows without a value take no part."""
    pages = df.filter(F.col(value).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, value))).alias("rows"))
    made = pages.withColumn("parts", partition_arrays(F.transform("rows", lambda r: r[value].cast("double")), centres))
    return made.select(key, F.explode(F.arrays_zip("rows", "parts")).alias("r")).select(key, F.col(f"r.rows.{order}"), F.col(f"r.rows.{value}"), F.col("r.parts").alias("part"))


def partition_to(values: Column, centres: Column) -> Column:
    """array<long>: the group of each of a row's ordered values, for the row's own centres. Rows with as many values and
    centres are worked out together; a row without centres has no groups."""

    @F.pandas_udf("array<long>")
    def parts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for column, to in batches:
            sizes = np.array([(len(v), len(c)) for v, c in zip(column, to, strict=True)]).reshape(-1, 2)
            out = np.empty(len(column), object)
            for n, k in np.unique(sizes, axis=0).tolist():
                at = np.flatnonzero((sizes == (n, k)).all(axis=1))
                step = max(1, (1 << 20) // max(1, n * max(1, k)))
                for i in range(0, len(at), step):
                    some = at[i : i + step]
                    stack = lambda s, m: np.array([np.asarray(s.iloc[j], float) for j in some]).reshape(len(some), m)
                    made = monotone_partition(stack(column, n), stack(to, k)) if k else np.empty((len(some), 0), np.int64)
                    for row, groups in zip(some, made, strict=True):
                        out[row] = groups
            yield pd.Series(out, index=column.index)

    return parts(values, centres)


def line_numbers(down: Column, tolerance: float) -> Column:
    """array<int>: of ordered values, the number (from 1) of the line of each: a line begins with the first value that is
    farther than the tolerance from the first of the line before."""

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(y: np.ndarray) -> np.ndarray:
            out, line, first = np.zeros(len(y), np.int32), 0, 0.0
            for i, v in enumerate(y.tolist()):
                if not line or abs(v - first) > tolerance:
                    line, first = line + 1, v
                out[i] = line
            return out

        for column in batches:
            yield column.map(lambda y: one(np.asarray(y, float)))

    return run(down)


def in_lines(df: DataFrame, page: list[str], y: str, x: str, text: str, tolerance: float = 2.0) -> DataFrame:
    """page, line (number, from 1, downwards), y (of the line's first fragment), x, text: fragments with the line that each
    belongs to. A page's fragments meet in one array. Downwards, a fragment belongs to the line above it while it is within
    the tolerance of that line's first fragment, not of the last one."""
    fragment = F.struct((-F.col(y)).cast("double").alias("down"), F.col(x).cast("double").alias("x"), F.col(text).alias("text"))
    pages = df.filter(F.col(y).isNotNull()).groupBy(*page).agg(F.sort_array(F.collect_list(fragment)).alias("all"))
    numbered = pages.withColumn("lines", line_numbers(F.transform("all", lambda f: f["down"]), tolerance))
    rows = numbered.select(*page, F.explode(F.arrays_zip("all", "lines")).alias("f")).select(*page, F.col("f.lines").alias("line"), "f.all.*")
    first = F.min("down").over(Window.partitionBy(*page, "line"))
    return rows.select(*page, "line", (-first).alias("y"), "x", "text")


def same_lines(df: DataFrame, page: str, y: str, x: str, text: str, tolerance: float = 2.0) -> DataFrame:
    """page, y, text: fragments of one line (see in_lines), joined by x."""
    lines = in_lines(df, [page], y, x, text, tolerance).groupBy(page, "line", "y").agg(F.sort_array(F.collect_list(F.struct("x", "text"))).alias("parts"))
    return lines.select(page, "y", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))


def columns_by_x(df: DataFrame, x: str, edges: list[float]) -> DataFrame:
    """cell: number, from 0, of the column that the fragment's x lies in; an edge belongs to the column on its right."""
    return df.withColumn("cell", sum((F.col(x) >= e).cast("int") for e in edges))


def fold(line: str, size: int = 75) -> str:
    """The line in parts of at most `size` UTF-8 bytes, continued by a space, never cut inside a character."""
    raw, parts, at = line.encode(), [], 0
    while len(raw) - at > (room := size - bool(parts)):
        stop = at + room
        while raw[stop] & 0xC0 == 0x80:
            stop -= 1
        parts.append(raw[at:stop])
        at = stop
    return b"\r\n ".join([*parts, raw[at:]]).decode()


@F.pandas_udf(StringType())
def fold_lines(lines: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in lines:
        yield part.map(lambda x: None if x is None else fold(x))
