"""Whitening of embeddings by principal components, refined in mixed precision.

Components become integers, so that sums and centred products are exact: one pass over the vectors adds up their sums,
one the products of what deviates from the mean, and the covariance is a quotient of integers. Its eigenvectors are found
in float32 and corrected by Ogita and Aishima's iteration, which only multiplies matrices, in extended precision. Where
eigenvalues lie too close together for that, each cluster is solved by itself, shifted by its mean, within the space that
its vectors span. Only matrices of dimension x dimension come to the driver, however many the rows are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import staged, table

COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000
#: Scaled components beyond this can't be counted with exactly; a component of less than this share has no variance.
MOST, LEAST_SHARE = float(1 << 52), 2.0**-50
WIDE = np.longdouble
MADE = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integer vectors) of the vectors that take part, one pair for each number of dimensions."""
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    there = vectors.is_valid().to_numpy(zero_copy_only=False)
    scaled = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    ends = np.cumsum(lengths)
    bad = np.append(0, np.cumsum(~(np.abs(scaled) <= MOST)))
    there &= bad[ends] == bad[ends - lengths]
    for d in np.unique(lengths[there]).tolist():
        rows = np.flatnonzero(there & (lengths == d))
        yield rows, scaled[(ends - d)[rows, None] + np.arange(d)].astype(np.int64) + SHIFT


def total(x: np.ndarray) -> np.ndarray:
    """Sums of the columns, as Python's integers."""
    few = len(x) * int(np.abs(x).max(initial=0)) < 1 << 62
    return x.sum(axis=0).astype(object) if few else x.astype(object).sum(axis=0)


def products(y: np.ndarray) -> np.ndarray:
    """y' y in Python's integers: by floats where these hold every partial sum."""
    if len(y) * int(np.abs(y).max(initial=0)) ** 2 < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    return y.T.astype(object) @ y.astype(object)


def summed(vectors: DataFrame, of: Callable[[np.ndarray], dict[int, np.ndarray]]) -> dict[int, dict[int, list[int]]]:
    """dimensions -> kind -> sums, of arrays that `of` makes of integer vectors: added up in each task, then over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for _, x in usable(batch.column("embedding")):
                for kind, values in of(x).items():
                    key = (x.shape[1], kind)
                    found[key] = found[key] + values.ravel() if key in found else values.ravel()
        for (d, kind), values in found.items():
            n, exact = len(values), pa.array([*values], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, d)), pa.array(np.full(n, kind, np.int32)), pa.array(np.arange(n)), exact], names=["d", "kind", "at", "value"])

    rows = vectors.mapInArrow(run, "d long, kind int, at long, value decimal(38,0)").groupBy("d", "kind", "at").agg(F.sum("value").alias("value"))
    out: dict[int, dict[int, list[int]]] = {}
    for r in rows.collect():  # as many rows as a matrix has entries
        out.setdefault(r.d, {}).setdefault(r.kind, []).append((r.at, int(r.value)))
    return {d: {kind: [v for _, v in sorted(x)] for kind, x in kinds.items()} for d, kinds in out.items()}


def clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Index sets of values that neighbours no farther than `near` tie together; single ones are left out."""
    order = np.argsort(values)
    parts = np.split(order, np.flatnonzero(np.diff(values[order]) > near) + 1)
    return [p for p in parts if len(p) > 1]


def eigen(a: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix in extended precision, falling, and unit eigenvectors as columns."""
    d = len(a)
    size = np.abs(a).max(initial=0)
    if not size:
        return np.zeros(d, WIDE), np.eye(d, dtype=WIDE)
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    eye, norm, before = np.eye(d, dtype=WIDE), np.sqrt((a * a).sum()), np.inf
    for _ in range(rounds):
        r, s = eye - x.T @ x, x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # rounding apart, they are; e divides what is left of it by small gaps
        values = np.diag(s) / (1 - np.diag(r))
        near = 2 * (np.sqrt(((s - np.diag(values)) ** 2).sum()) + norm * np.sqrt((r * r).sum()))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > near
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        for part in clusters(values, near):
            own = x[:, part]
            t = own.T @ (a @ own - values[part].mean() * own)
            t = (t + t.T) / 2
            high = np.abs(t).max()
            if np.abs(t - np.diag(np.diag(t))).max() > 2.0**-62:
                x[:, part] = own @ np.linalg.eigh((t / high).astype(np.float64))[1].astype(WIDE)
        change = np.abs(e).max()
        if change < 2.0**-60 or change < 2.0**-50 and change > before / 2:
            break
        before = change
    x = x + x @ (eye - x.T @ x) / 2
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    top = x[np.abs(x).argmax(axis=0), np.arange(d)]
    return values[order] * size, x * np.where(top < 0, -1, 1)


def covariance(n: int, sums: list[int], around: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Of integers, in extended precision: gram holds the products of what deviates from the integers `around`."""
    rest = np.array([s - n * int(m) for s, m in zip(sums, around, strict=True)], object)
    return (n * gram - np.outer(rest, rest)).astype(WIDE) / (WIDE(n) * WIDE(n))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of vectors (vec_id, embedding array), a row for
    each vector and component.

    Null vectors, and those with a null or non-finite entry, take no part; nor do entries of more than 2 ** 52 when
    scaled, which can't be counted with exactly. Of vectors of several lengths, the most frequent length takes part (of
    equally frequent ones the longest); an empty vector has no components. Rows that repeat count each; a null vec_id
    stays null. A component without variance (fewer distinct vectors than dimensions, say) is 0 for every row, explains
    0, and the identity's error is that of the others. A deviation that no long holds is null. An empty table gives no
    rows. Other columns aren't read.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    sums = summed(kept.select("embedding"), lambda x: {0: np.array([len(x)], object), 1: total(x)})
    sums.pop(0, None)
    if not sums:
        return spark.createDataFrame([], MADE)
    d = max(sums, key=lambda d: (sums[d][0][0], d))
    n, sum_x = sums[d][0][0], sums[d][1]
    around = np.array([s // n for s in sum_x], np.int64)
    gram = summed(kept.select("embedding"), lambda x: {0: products(x - around)} if x.shape[1] == d else {})[d][0]
    values, axes = eigen(covariance(n, sum_x, around, np.array(gram, object).reshape(d, d)))
    trace = values.sum()
    k = min(components, d)
    real = [bool(trace > 0 and values[i] > trace * LEAST_SHARE) for i in range(k)]
    to = np.array([axes[:, i] / np.sqrt(values[i]) if real[i] else np.zeros(d) for i in range(k)], np.float64).T
    explained = [float(values[i] / trace) if real[i] else 0.0 for i in range(k)]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in usable(batch.column("embedding")):
                if x.shape[1] != d:
                    continue
                small = n * (int(np.abs(x).max()) + max(map(abs, sum_x)) // n + 1) < 1 << 62
                apart = n * (x if small else x.astype(object)) - np.array(sum_x, np.int64 if small else object)
                if small and d * int(np.abs(apart).max()) ** 2 < 1 << 63:
                    deviation = (apart * apart).sum(axis=1).tolist()
                else:
                    deviation = [v if (v := sum(int(y) ** 2 for y in row)) < 1 << 63 else None for row in apart]
                made = (apart.astype(np.float64) / n) @ to
                cells = pa.ListArray.from_arrays(pa.array(np.arange(0, made.size + 1, k, np.int32)), pa.array(made.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), pa.array(deviation, pa.int64()), cells], names=["vec_id", "deviation", "cells"])

    made, _ = staged(kept.mapInArrow(project, "vec_id long, deviation long, cells array<double>"), "whitened")
    error = identity_error(made, [i for i in range(k) if real[i]])
    return made.select("vec_id", "deviation", F.posexplode("cells").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(F.array(*map(F.lit, explained)), F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )


def identity_error(made: DataFrame, of: list[int]) -> float:
    """Largest entry of the covariance of cells[i], for i in `of`, minus the identity: measured on the rows."""
    if not of:
        return 0.0
    cell: Callable[[int], Column] = lambda i: F.col("cells")[i]
    means = made.agg(*[F.avg(cell(i)) for i in of]).first()
    apart = [cell(i) - F.lit(m) for i, m in zip(of, means, strict=True)]
    pairs = [(i, j) for i in range(len(of)) for j in range(i + 1)]
    found = made.agg(*[F.avg(apart[i] * apart[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs, strict=True))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
