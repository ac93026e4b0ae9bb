"""Exact top-k search by inner product, on an index in order of impact, score at a time.

Components become integers. A block of candidates is indexed by postings: of each dimension, one segment for each number
of bits that absolute values have there, with the candidates and values in it. A query processes segments by descending
quantised impact, its own component times the segment's largest value; what a candidate may still gain or lose is at
most the sum over dimensions of the largest impact that is left there. The query stops as soon as few candidates may
still be among its k best, or have a score that another block already gives k times; these alone are scored exactly.
A group of queries goes through a block together, level by level of quantised impact: the segments that are due at a level
for any of them are laid out as rows, and one product adds each query's share. Queries that are done leave the group.
Partial sums are integers that a double holds; where one might not, that query goes segment by segment in integers of 64
bits, or in Python's integers, by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import staged, table

K, BLOCK, GROUP = 20, 8192, 1024
#: Partial sums stay below this; what lies lower than any sum stands for the query's own rows.
MOST, NONE = 1 << 61, -(1 << 62)
#: Partial sums of groups stay below this; segments that are laid out at a time.
EXACT, LAID_OUT = 1 << 52, 128


class ImpactIndex:
    """ids ascending; vectors: integers, one row an id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.exact = ids[order], vectors[order]
        size = np.abs(self.exact)
        bits = np.frexp(size.astype(np.float64))[1]
        member, dimension = np.nonzero(size)
        level = bits[member, dimension]
        order = np.lexsort((member, -level, dimension))
        self.member, dimension, level = member[order].astype(np.int32), dimension[order], level[order]
        self.value = self.exact[self.member, dimension]
        first = np.flatnonzero(np.diff(dimension, prepend=-1) | np.diff(level, prepend=-1))
        self.start, self.stop = first, np.append(first[1:], len(order))
        self.dimension = dimension[first]
        self.top = np.maximum.reduceat(size[self.member, dimension], first) if len(first) else np.empty(0, np.int64)
        # Behind a segment, its dimension may still give what the next one holds at most.
        same = np.append(self.dimension[1:] == self.dimension[:-1], False) if len(first) else np.empty(0, bool)
        self.drop = self.top - np.where(same, np.append(self.top[1:], 0), 0) if len(first) else self.top

    def search(self, query: np.ndarray, own: int, k: int, least: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best, ties to the smaller id, without the query's own id; with `least`, those below it
        may be missing."""
        n, few = len(self.ids), max(4 * k, len(self.ids) // 50)
        weight = np.abs(query)
        if float(np.sum(weight.astype(np.float64) * np.abs(self.exact).max(axis=0, initial=0))) >= MOST:
            return self.best(query.astype(object), np.arange(n), own, k)
        floor = NONE if least is None else least
        impact = weight[self.dimension] * self.top
        order = np.argsort(-impact, kind="stable")
        order = order[impact[order] > 0]
        quantised = np.frexp(impact[order].astype(np.float64))[1]
        left = int((weight[self.dimension] * self.drop).sum()) - np.cumsum((weight[self.dimension] * self.drop)[order])
        sums = np.zeros(n, np.int64)
        low, high = np.searchsorted(self.ids, own), np.searchsorted(self.ids, own, side="right")
        for i, segment in enumerate(order.tolist()):
            at = slice(self.start[segment], self.stop[segment])
            sums[self.member[at]] += self.value[at] * query[self.dimension[segment]]
            if i + 1 < len(order) and quantised[i + 1] == quantised[i]:
                continue
            sums[low:high] = NONE
            reach = int(left[i])
            kth = int(np.partition(sums, n - k)[n - k]) if n > k else NONE
            possible = np.flatnonzero(sums >= max(kth - 2 * reach, floor - reach, NONE + 1))
            if len(possible) <= few:
                return self.best(query, possible, own, k)
        return self.best(query, np.arange(n), own, k)

    def laid_out(self, segments: np.ndarray, kind: type) -> np.ndarray:
        """The segments' values by candidate, a row each."""
        rows = np.zeros((len(segments), len(self.ids)), kind)
        sizes = self.stop[segments] - self.start[segments]
        at = np.repeat(self.start[segments] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        rows[np.repeat(np.arange(len(segments)), sizes), self.member[at]] = self.value[at]
        return rows

    def search_all(self, queries: np.ndarray, owns: np.ndarray, k: int, least: list[int | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """What search gives, for each of the queries (rows)."""
        n, few = len(self.ids), max(4 * k, len(self.ids) // 50)
        found: list = [None] * len(queries)
        weight = np.abs(queries)
        most = weight.astype(np.float64) @ np.abs(self.exact).max(axis=0, initial=0).astype(np.float64)
        small = most < EXACT
        kind = np.float32 if most[small].max(initial=0) < 1 << 23 else np.float64  # either holds every partial sum
        for i in np.flatnonzero(~small).tolist():
            found[i] = self.search(queries[i], int(owns[i]), k, least[i])
        rows = np.flatnonzero(small)
        impact = weight[rows][:, self.dimension] * self.top
        level = np.where(impact > 0, np.frexp(impact.astype(np.float64))[1], -1)
        gone = weight[rows][:, self.dimension] * self.drop
        left = gone.sum(axis=1)
        floor = np.array([NONE if least[i] is None else least[i] for i in rows.tolist()], np.float64)
        sums = np.zeros((len(rows), n), kind)
        for r, i in enumerate(rows.tolist()):
            sums[r, np.searchsorted(self.ids, owns[i]) : np.searchsorted(self.ids, owns[i], side="right")] = -np.inf

        def done(limit: np.ndarray, which: np.ndarray) -> None:
            for r in which.tolist():
                members = np.flatnonzero((sums[r] >= limit[r]) & (sums[r] > -np.inf))
                found[rows[r]] = self.best(queries[rows[r]], members, int(owns[rows[r]]), k)
                active[r] = False
            nonlocal group
            group = np.flatnonzero(active)

        active, group = np.ones(len(rows), bool), np.arange(len(rows))
        kth = lambda: np.partition(sums[group], n - k, axis=1)[:, n - k].astype(np.float64) if n > k else np.full(len(group), -np.inf)
        limit = np.empty(len(rows))
        for now in np.unique(level)[::-1].tolist():
            if now < 0 or not len(group):
                break
            due = level[group] == now
            segments = np.flatnonzero(due.any(axis=0))
            if not len(segments):
                continue
            mine = slice(None) if len(group) == len(rows) else group
            more = None
            for j in range(0, len(segments), LAID_OUT):
                part = segments[j : j + LAID_OUT]
                share = np.where(due[:, part], queries[rows[group]][:, self.dimension[part]], 0).astype(kind) @ self.laid_out(part, kind)
                more = share if more is None else np.add(more, share, out=more)
            sums[mine] += more
            left[group] -= (gone[group] * due).sum(axis=1)
            # While most of it is left, no query can be done.
            if (left[group] > gone[group].sum(axis=1) / 2).all():
                continue
            limit[group] = np.maximum(kth() - 2 * left[group], floor[group] - left[group])
            count = (sums[group] >= limit[group][:, None]).sum(axis=1)
            done(limit, group[count <= few])
        if len(group):
            limit[group] = np.maximum(kth(), floor[group])
            done(limit, group)
        return found

    def best(self, query: np.ndarray, members: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        members = members[self.ids[members] != own]
        scores = (self.exact[members].astype(query.dtype) @ query) if len(members) else np.empty(0, np.int64)
        order = np.lexsort((self.ids[members], -scores))[:k]
        return self.ids[members][order], scores[order]


def matrix(ids: pa.Array, vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and vectors as floor(64 * component); shorter vectors are filled up with zeros."""
    flat = np.floor(64.0 * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if np.abs(flat).max(initial=0) >= MOST:
        raise ValueError("a component is too large for scores of 64 bits")
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(ids), width), np.int64)
    row = np.repeat(np.arange(len(ids)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat.astype(np.int64)
    return ids.to_numpy(zero_copy_only=False), out


def search(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of vectors (vec_id long, embedding array) for each of queries
    (the same columns), ties to the smaller vec_id, the query's own vec_id left out; all, if there are fewer.

    Rows with a null vec_id, a null vector, or a null or non-finite component take no part on either side. A shorter
    vector is filled up with zeros; scores are to fit a long, and a component beyond 2 ** 55 stops the query. Repeated
    rows with one vec_id are candidates each, but one query: the least of their vectors is asked. An empty table gives no
    rows. Other columns aren't read.
    """
    usable = "vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(usable)
    asked = queries.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(usable).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    blocks = -(-max(1, kept.count()) // block)
    groups = -(-max(1, asked.count()) // group)
    candidates = kept.groupBy(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("vec_id", "embedding")).alias("block_rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                rows, wanted = batch.column("block_rows")[at].values, batch.column("part_rows")[at].values
                width = max(int(pc.max(s.field("embedding").value_lengths()).as_py() or 0) for s in (rows, wanted))
                index = ImpactIndex(*matrix(rows.field("vec_id"), rows.field("embedding"), width))
                out: list[list[np.ndarray]] = [[], [], []]
                owns, asking = matrix(wanted.field("vec_id"), wanted.field("embedding"), width)
                for own, (found, scores) in zip(owns, index.search_all(asking, owns, k, wanted.field("least").to_pylist()), strict=True):
                    for into, x in zip(out, (np.full(len(found), own), found, scores), strict=True):
                        into.append(x)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out], names=["query_id", "vec_id", "score"])

    def searched(some: DataFrame, where: str) -> DataFrame:
        """some: vec_id, embedding, least; where: SQL for the blocks (array) that a part of the queries is copied to."""
        parts = some.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(groups)).alias("part")).agg(F.collect_list(F.struct("vec_id", "embedding", "least")).alias("part_rows"))
        copied = parts.withColumn("block", F.explode(F.expr(where)))
        pairs = candidates.join(copied, "block").repartition(max(1, min(blocks * groups, 20_000)), "block", "part")
        found = pairs.select("block_rows", "part_rows").mapInArrow(run, "query_id long, vec_id long, score long")
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
        return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    asked = asked.withColumn("least", F.lit(None).cast("long"))
    if blocks > 1:
        # The k-th score of one block bounds that of all: no candidate below it need be scored in the others.
        seed, _ = staged(searched(asked, f"array(pmod(part, {blocks}))").filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least")), "seed")
        asked = asked.drop("least").join(seed, "vec_id", "left")
    # Queries are copied to each block of candidates: their set grows with the table, and so does what is asked for.
    return searched(asked, f"sequence(0L, {blocks - 1}L)")


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter("vec_id % 20 = 0"))


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
), q AS (
  SELECT vec_id, list_transform(min(embedding), lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings GROUP BY 1
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
