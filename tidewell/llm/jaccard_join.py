"""N-gram Jaccard join by partitioning the universe of shingles.

Two sets whose Jaccard similarity reaches the threshold differ in few elements: at most H of them, which follows from
their sizes. For each size band the universe of shingles is hashed into segments, and each set's part of a segment gets
a signature. If a set has credits for more than H differences, one segment at least must pay: a plain segment has one
credit and pays when both parts are equal, a wide one has two and pays when they differ by one element at most, which
the signatures of its one-deletion neighbourhood show. How many segments of either kind a band gets is chosen by cost.
A second choice by cost falls on lists: a set needn't look into its longest lists while the others still hold enough
credits. Every candidate is verified on its words.

Links are found in rounds, since only components are asked for: each set is compared with the one that it shares most
signatures with as the first of their lists, then come the other pairs of short lists and the stars of long ones, then
some pairs of long lists and last all others, and in each round only pairs across components that their sketches don't
tell apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import U64, WordHash, columns, discard, mix64, powers, slices, staged, table, texts_of
from tidewell.llm.graph import components

SHINGLE, NUM, DEN = 5, 80, 100
#: Lists up to this long give all their pairs at once; longer ones wait for the first components.
SHORT_LIST = 16
#: Members of a longer list that are looked through in one place.
PART = 4096
FLUSH = 500_000
#: So many names of sets, of 8 bytes each, may be broadcast.
SMALL = 50_000
#: Parts that a bucket's signatures are matched in, one after the other.
PARTS = 8
#: Credits that a band's sets shall have for each one they need: what is spare lets them pass by long lists.
SPARE = 1.12
#: 64-bit words of the sketch of a set: for each bit, whether an odd number of elements falls on it.
SKETCH = 16
BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def edges_of_bands() -> np.ndarray:
    """Smallest size of each band; each spans a factor of 1.5625, so that similar sets are in one band or neighbours."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, math.ceil(out[-1] * 1.5625)))
    return np.array(out)


def differences(n: int, partner: int, num: int = NUM, den: int = DEN) -> int:
    """How many elements sets of these sizes may differ in at most."""
    return (den - num) * (n + partner) // (den + num)


@lru_cache(maxsize=256)
def allocation(band: int, num: int, den: int) -> tuple[int, int]:
    """(segments, how many of them are wide) for pairs whose larger set is in the band: the cheapest choice that is
    expected to give the band's smallest and largest sets the credits they need. Cost: signatures, and the chance that
    a part is so small that unlike sets share it."""
    edge = edges_of_bands()
    low, high = int(edge[band]), int(edge[band + 1]) - 1
    small = -(-low * num // den)
    best = (float("inf"), 1, 1)
    least = differences(high, high, num, den) + 1
    for segments in range(max(1, least // 2), least + least // 2 + 4):
        for wide in sorted({*range(min(segments, 4) + 1), segments}):
            enough, cost = True, 0.0
            for n in (small, high):
                r = n / segments
                none, one = math.exp(-r), r * math.exp(-r)
                credits = (segments - wide) * (1 - none) + wide * (2 * (1 - none - one) + one)
                need = differences(n, min(n * den // num, high), num, den) + 1
                enough &= credits >= need * SPARE + 1.5 * math.sqrt(segments * none) or segments == wide == 1 and need <= 2
                cost += (segments - wide) * (1 + 4 * none + 2 * one) + wide * (2 + r + 8 * none)
            if enough and cost < best[0]:
                best = (cost, segments, wide)
    return best[1:]


class Shingler:
    def __init__(self, n: int = SHINGLE):
        self.n, self.word, self.power = n, WordHash(), powers(BASE, n)

    def hashes(self, text: bytes) -> np.ndarray:
        """Distinct 64-bit hashes of the text's shingles, A-Z taken as a-z; of all its words as one, if they are fewer."""
        words = text.lower().split()
        if not words:
            return np.empty(0, U64)
        w = self.word.many(words)
        k = min(self.n, len(words))
        out = np.zeros(len(words) - k + 1, U64)
        for j in range(k):
            out += w[j : len(words) - k + 1 + j] * self.power[j]
        return np.unique(mix64(out + U64(k)))


def signatures(sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries (signature, wide, row) of sets that aren't empty, and the rows (set, band, spare): one for each set and
    band of a larger partner. spare: credits beyond those that the set needs."""
    size = np.array([len(x) for x in sets])
    edge = edges_of_bands()
    own = np.searchsorted(edge, size, side="right") - 1
    more = np.flatnonzero(size * den >= num * edge[own + 1])
    which = np.concatenate([np.arange(len(sets)), more])
    band = np.concatenate([own, own[more] + 1])
    chosen = np.array([allocation(int(b), num, den) for b in band])
    segments, wide = chosen[:, 0], chosen[:, 1]
    n = size[which]
    partner = np.minimum(n * den // num, edge[band + 1] - 1)
    need = (den - num) * (n + partner) // (den + num) + 1

    tokens = np.concatenate([sets[i] for i in which])
    row = np.repeat(np.arange(len(which)), n)
    spread = mix64(tokens ^ mix64((band.astype(U64) + U64(1)) << U64(32))[row])
    segment = ((spread >> U64(32)) * segments[row].astype(U64) >> U64(32)).astype(np.int64)
    first = np.cumsum(segments) - segments
    at = first[row] + segment
    total = int(segments.sum())
    count = np.bincount(at, minlength=total)
    low = np.bincount(at, (tokens & U64(0xFFFFFFFF)).astype(np.float64), total).astype(U64)
    high = np.bincount(at, (tokens >> U64(32)).astype(np.float64), total)
    sums = low + (np.fmod(high, 2.0**32).astype(U64) << U64(32))
    owner = np.repeat(np.arange(len(which)), segments)
    index = np.arange(total) - first[owner]
    is_wide = index < wide[owner]
    salt = mix64((band[owner].astype(U64) << U64(40)) + index.astype(U64) + U64(BASE))

    credits = np.bincount(owner, np.where(is_wide, np.minimum(count, 2), np.minimum(count, 1)), len(which)).astype(np.int64)
    spare = credits - need
    full = np.flatnonzero(count)
    drop = np.flatnonzero(is_wide[at] & (count[at] > 1))
    # Two sets of which neither has the credits it needs are compared by single shingles.
    single = np.flatnonzero((spare < 0)[row])
    signature = np.concatenate([mix64(sums[full] + salt[full]), mix64(sums[at[drop]] - tokens[drop] + salt[at[drop]]), mix64(tokens[single] + mix64(band[row[single]].astype(U64) + U64(7)))])
    flag = np.concatenate([is_wide[full], np.ones(len(drop) + len(single), bool)])
    entry_row = np.concatenate([owner[full], row[drop], row[single]])
    return signature, flag, entry_row, which, band, np.maximum(spare, 0)


HEADER = np.dtype([("node", "<u8"), ("band", "u1"), ("spare", "<u2")])
META = np.dtype([("node", "<u8"), ("check", "<u8"), ("n", "<i8"), ("text", "<i8"), ("doc", "<i8"), ("known", "u1"), ("sketch", "<u8", (SKETCH,))])


def emit(docs: DataFrame, buckets: int, n: int, num: int, den: int) -> DataFrame:
    """bucket, blob: signatures by their hash, and in buckets below 0 what is kept of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        seen: set[int] = set()
        held, rows, heads = [], 0, []
        n_held = 0

        def flush() -> pa.RecordBatch | None:
            nonlocal held, heads, rows, n_held
            if not held:
                return None
            signature = np.concatenate([x[0] for x in held])
            packed = (signature & U64((1 << 47) - 1)) << U64(17) | np.concatenate([x[1] for x in held])
            head = np.concatenate(heads)
            bucket = ((signature >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            packed, bucket = packed[order], bucket[order]
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            blobs = []
            for i, j in zip(starts, [*starts[1:], len(bucket)], strict=True):
                used, local = np.unique(packed[i:j] & U64(0xFFFF), return_inverse=True)
                part = packed[i:j] & ~U64(0xFFFF) | local.astype(U64)
                blobs.append(len(used).to_bytes(4, "little") + head[used.astype(np.int64)].tobytes() + part.tobytes())
            held, heads, rows, n_held = [], [], 0, 0
            return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

        turn = 0
        for batch in slices(batches, limit=1 << 20):
            sets = [shingler.hashes(t) for t in texts_of(batch)]
            sums = [x.sum(dtype=U64) if len(x) else U64(0) for x in sets]
            meta = np.zeros(len(sets), META)
            meta["n"] = [len(x) for x in sets]
            meta["node"] = np.where(meta["n"] > 0, mix64(np.array(sums, U64) + meta["n"].astype(U64)), 0)
            meta["check"] = [mix64(x).sum(dtype=U64) if len(x) else 0 for x in sets]
            meta["text"] = batch.column("key").to_numpy(zero_copy_only=False)
            meta["doc"] = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            for i, x in enumerate(sets):
                bit = (mix64(x ^ U64(BASE)) >> U64(32)) * U64(64 * SKETCH) >> U64(32)
                odd = np.bincount(bit.astype(np.int64), minlength=64 * SKETCH).astype(np.uint8) & 1
                meta["sketch"][i] = np.packbits(odd).view("<u8")
            meta["known"] = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            turn += 1
            yield pa.RecordBatch.from_arrays([pa.array([-1 - turn % buckets], pa.int32()), pa.array([meta.tobytes()], pa.binary())], names=["bucket", "blob"])
            new = []
            for i, node in enumerate(meta["node"].tolist()):
                if node and node not in seen:
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(node)
                    new.append(i)
            if not new:
                continue
            signature, wide, row, which, band, spare = signatures([sets[i] for i in new], num, den)
            head = np.zeros(len(which), HEADER)
            head["node"], head["band"], head["spare"] = meta["node"][new][which], band, np.minimum(spare, 65535)
            if rows + len(head) > 60_000 or n_held + len(signature) > FLUSH:
                done = flush()
                if done is not None:
                    yield done
            held.append((signature, (wide.astype(U64) << U64(16)) | (row + rows).astype(U64)))
            heads.append(head)
            rows += len(head)
            n_held += len(signature)
        done = flush()
        if done is not None:
            yield done

    return docs.mapInArrow(run, "bucket int, blob binary")


FOUND = "kind byte, a long, b long, n long, star long, band int, spare int, wide boolean, known boolean, extra long, " + ", ".join(f"s{i} long" for i in range(SKETCH))
FOUND_ARROW = pa.schema([("kind", pa.int8()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("star", pa.int64()), ("band", pa.int32()), ("spare", pa.int32()), ("wide", pa.bool_()), ("known", pa.bool_()), ("extra", pa.int64()), *((f"s{i}", pa.int64()) for i in range(SKETCH))])


def found_rows(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray, star: np.ndarray, band=None, spare=None, wide=None, known=None, extra=None, sketch=None) -> pa.RecordBatch:  # noqa: ANN001
    k = len(a)
    zero = np.zeros(k, np.int64)
    as_int = lambda x: x.view(np.int64) if x.dtype == U64 else x.astype(np.int64)
    arrays = [np.full(k, kind, np.int8), as_int(a), as_int(b), as_int(n), as_int(star), (zero if band is None else band).astype(np.int32), (zero if spare is None else spare).astype(np.int32), (zero if wide is None else wide).astype(bool), (zero if known is None else known).astype(bool), as_int(zero if extra is None else extra)]
    arrays += [pa.nulls(k, pa.int64()) if sketch is None else as_int(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH)]
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in arrays], schema=FOUND_ARROW)


def match_bucket(blobs: list[bytes], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Pairs of sets in short lists, stars of long ones (kind 0), and the members of long lists (kind 1)."""
    heads, packed, shift = [], [], 0
    for blob in blobs:
        k = int.from_bytes(blob[:4], "little")
        heads.append(np.frombuffer(blob, HEADER, k, 4))
        part = np.frombuffer(blob, "<u8", offset=4 + k * HEADER.itemsize)
        packed.append((part >> U64(16), (part & U64(0xFFFF)).astype(np.int64) + shift))
        shift += k
    head = np.concatenate(heads)
    key = np.concatenate([x[0] for x in packed])
    row = np.concatenate([x[1] for x in packed]).astype(np.int32)
    packed.clear()
    nodes, rank = np.unique(head["node"], return_inverse=True)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for part in range(PARTS):  # bounds what the pairs of lists take at a time
        some = np.flatnonzero((key >> U64(1)) % U64(PARTS) == part)
        yield from match_part(key[some], row[some], head, nodes, rank, found, num, den)
    if found:
        both, where = np.unique(np.concatenate([x[0] for x in found]), return_inverse=True)
        n, star = (np.bincount(where, np.concatenate([x[i] for x in found])) for i in (1, 2))
        yield found_rows(0, nodes[both >> 32], nodes[both & 0xFFFFFFFF], n, star, spare=fewest(np.concatenate([x[3] for x in found]), where, len(both)))


def fewest(values: np.ndarray, where: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, np.iinfo(np.int32).max)
    np.minimum.at(out, where, values)
    return out


def match_part(key: np.ndarray, row: np.ndarray, head: np.ndarray, nodes: np.ndarray, rank: np.ndarray, found: list, num: int, den: int) -> Iterator[pa.RecordBatch]:
    if not len(key):
        return
    order = np.argsort(key >> U64(1), kind="stable")
    ranked = (key >> U64(1))[order]
    same = ranked[1:] == ranked[:-1]
    order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]  # most signatures are of one set
    if not len(order):
        return
    row, wide, key = row[order], (key[order] & U64(1)).astype(bool), key[order] >> U64(1)
    member = rank[row].astype(np.int64)
    order = np.lexsort((member, key))
    key, member, row, wide = key[order], member[order], row[order], wide[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (member[1:] != member[:-1])
    key, member, row, wide = key[first], member[first], row[first], wide[first]
    starts = np.flatnonzero(np.diff(key, prepend=key[:1] + U64(1))) if len(key) else np.empty(0, np.int64)
    length = np.diff(np.append(starts, len(key)))
    # Sets that link have so many signatures in common, or more: those that their differences leave of either one's.
    bands = head["band"][row]
    plain = np.isin(bands, [b for b in np.unique(bands).tolist() if not allocation(int(b), num, den)[1]])
    shares = np.where(plain, head["spare"][row].astype(np.int64) + 1, 0)
    pairs, stars, least = [], [], []
    for c in range(2, SHORT_LIST + 1):
        at = starts[length == c]
        if len(at):
            members, share = member[at[:, None] + np.arange(c)], shares[at[:, None] + np.arange(c)]
            i, j = np.triu_indices(c, 1)
            pairs.append((members[:, i] << 32 | members[:, j]).ravel())
            stars.append(np.broadcast_to(i == 0, (len(at), len(i))).ravel())
            least.append(np.maximum(share[:, i], share[:, j]).ravel())
    at, c = starts[length > SHORT_LIST], length[length > SHORT_LIST]
    if len(at):
        begin = np.repeat(at, c)
        every = begin + np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        yield found_rows(1, key[every], nodes[member[every]], np.repeat(c, c), np.zeros(len(every)), head["band"][row[every]], head["spare"][row[every]], wide[every])
        other = every != begin
        pairs.append(member[begin[other]] << 32 | member[every[other]])
        stars.append(np.ones(int(other.sum()), bool))
        least.append(np.maximum(shares[begin[other]], shares[every[other]]))
    if pairs:
        both, where, n = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
        found.append((both, n, np.bincount(where, np.concatenate(stars)), fewest(np.concatenate(least), where, len(both))))


def match(entries: DataFrame, buckets: int, num: int, den: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                if bucket < 0:
                    m = np.frombuffer(blob, META)
                    yield found_rows(2, m["node"], m["doc"], m["n"], m["text"], known=m["known"], extra=m["check"], sketch=m["sketch"])
                    continue
                if bucket != now:
                    if blobs:
                        yield from match_bucket(blobs, num, den)
                    now, blobs = bucket, []
                blobs.append(blob)
        if blobs:
            yield from match_bucket(blobs, num, den)

    place = F.when(F.col("bucket") < 0, -1 - F.col("bucket")).otherwise(F.col("bucket"))
    return entries.repartitionById(buckets, place).sortWithinPartitions("bucket").mapInArrow(run, FOUND)


def verified(pairs: DataFrame, texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Those of the pairs (a, b) whose texts link."""

    def shingles(text: bytes) -> set[tuple[bytes, ...]]:
        words = text.lower().split()
        return set(zip(*(words[j:] for j in range(n)), strict=False)) if len(words) >= n else {tuple(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, one = None, set()
        for batch in batches:
            keep = []
            for a, text_a, text_b in zip(batch.column("a").to_pylist(), texts_of(batch, "text_a"), batch.column("text_b").cast(pa.binary()), strict=True):
                if a != last:
                    last, one = a, shingles(text_a)
                other = shingles(text_b.as_py() or b"")
                common = len(one & other)
                keep.append(den * common >= num * (len(one) + len(other) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    needed, _ = staged(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "needed")
    if needed.count() <= SMALL:  # else most texts are needed, and dealing them out is the cheaper way
        texts = texts.join(F.broadcast(needed), "node", "left_semi")
    member = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    leader = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    return pairs.join(member, "b").join(leader, "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "u long, v long")


def may_link(num: int, den: int) -> str:
    """On columns n, s0.. of two sets x and y: false only if they can't link. Each bit in which the sketches differ
    stands for an element at least that only one of the sets has."""
    unlike = " + ".join(f"bit_count(x.s{i} ^ y.s{i})" for i in range(SKETCH))
    return f"least(x.n, y.n) * {den} >= greatest(x.n, y.n) * {num} and ({unlike}) * {den + num} <= (x.n + y.n) * {den - num}"


def across(pairs: DataFrame, nodes: DataFrame, label: DataFrame, num: int, den: int) -> DataFrame:
    """Those of the pairs (a, b, n, least) that may link two components: n signatures in common, not counting those in
    long lists, least as it takes. Sketches are fetched only for pairs across."""
    for side in "ab":
        pairs = pairs.join(label.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}")), side, "left")
    pairs = pairs.filter("coalesce(of_a, a) <> coalesce(of_b, b)").select("a", "b", F.col("n").alias("shared"), "least")
    x, y = (nodes.select([F.col(c).alias(side if c == "node" else f"{side}_{c}") for c in nodes.columns]) for side in "ab")
    return pairs.join(x, "a").join(y, "b").filter("shared + least(a_long, b_long) >= least").filter(may_link(num, den).replace("x.", "a_").replace("y.", "b_")).select("a", "b")


def look_through(batches: Iterator[pa.RecordBatch], num: int, den: int, partners: int | None) -> Iterator[pa.RecordBatch]:
    """Pairs of a set that looks and a member of the same part of a long list, of unlike components, that may link. Rows
    come sorted by list, part and looks. With `partners`, so many for each set that looks: those of the least pair hash."""
    names = [f"s{i}" for i in range(SKETCH)]
    now: tuple[int, int] | None = None
    held: list[tuple[np.ndarray, ...]] = []
    members: tuple[np.ndarray, ...] | None = None

    def arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        one = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
        return one("b"), one("component"), one("n"), np.stack([one(c) for c in names]).view(U64)

    def pairs(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(x[0]), 256):
            b, component, n, sketch = (v[..., at : at + 256] for v in x)
            unlike = np.zeros((len(b), len(y[0])), np.int64)
            for i in range(SKETCH):
                unlike += np.bitwise_count(sketch[i][:, None] ^ y[3][i][None, :])
            small, large = np.minimum(n[:, None], y[2]), np.maximum(n[:, None], y[2])
            may = (small * den >= large * num) & (unlike * (den + num) <= (small + large) * (den - num)) & (component[:, None] != y[1])
            i, j = np.nonzero(may)
            u, v = b[i], y[0][j]
            if partners:
                order = np.lexsort((mix64(u.view(U64) ^ v.view(U64)), i))
                place = np.arange(len(i)) - np.searchsorted(i, i)
                order = order[place < partners]
                u, v = u[order], v[order]
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        lists, parts, looks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "part", "looks"))
        every = arrays(batch)
        new = np.ones(len(lists), bool)
        new[1:] = (lists[1:] != lists[:-1]) | (parts[1:] != parts[:-1]) | (looks[1:] != looks[:-1])
        starts = np.flatnonzero(new)
        for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(lists)], strict=True):
            some = tuple(x[..., i:j] for x in every)
            if (lists[i], parts[i]) != now:
                now, held, members = (lists[i], parts[i]), [], None
            if not looks[i]:
                held.append(some)
            elif held:
                if members is None:
                    members = tuple(np.concatenate([x[k] for x in held], axis=-1) for k in range(4))
                yield from pairs(some, members)


def mixed_lists(lists: DataFrame, label: DataFrame) -> tuple[DataFrame, str]:
    """Members of those long lists that hold several components, with main: whether the set is of the component that has
    most members there. A list within one component has nothing to add."""
    known = lists.join(label.withColumnRenamed("node", "b"), "b", "left").withColumn("component", F.coalesce("component", "b"))
    sizes = known.groupBy("a", "component").agg(F.count("*").alias("size"))
    mixed = sizes.groupBy("a").agg(F.max_by("component", F.struct("size", "component")).alias("most"), F.count("*").alias("kinds")).filter("kinds > 1").drop("kinds")
    return staged(known.join(mixed, "a").select("a", "b", "component", F.col("n").alias("long"), "band", "spare", "wide", (F.col("component") == F.col("most")).alias("main")), "mixed")


def long_list_pairs(members: DataFrame, nodes: DataFrame, num: int, den: int, partners: int | None = None) -> DataFrame:
    """Pairs that mixed lists hold and that may link two components. A set looks into those of wide segments, and into as
    many of plain segments, shortest first, as leave it no more unread ones than it has credits to spare. The sets of a
    list's main component needn't look there: the other set of the pair does. Members are dealt out in parts of some
    thousands, each looked through in one place by the sets that look, so that no join gives the pairs of a list. With
    `partners`, each set looks for so many in one part of two lists or so only, which leaves less to do for the whole
    search."""
    parts = F.ceil(F.col("long") / PART).cast("int")
    own = F.pmod(F.xxhash64("b", F.lit(partners or 0)), parts).cast("int")
    if partners:
        count = members.groupBy("b").agg(F.count("*").alias("of"))
        looking = members.filter("not main").join(count, "b").filter("pmod(xxhash64(a, b), of) < 2").withColumn("part", own)
    else:
        by_set = Window.partitionBy("b", "band")
        unread = F.sum(F.when(~F.col("wide"), 1).otherwise(0)).over(by_set)
        turn = F.row_number().over(by_set.orderBy("wide", "long", "a"))
        marked = members.withColumn("unread", unread).withColumn("turn", turn).filter("(wide or turn <= unread - spare) and not main")
        looking = marked.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    taken = ["a", "part", "b", "component"]
    rows = looking.select(*taken, F.lit(True).alias("looks")).unionByName(members.withColumn("part", own).select(*taken, F.lit(False).alias("looks")))
    rows = rows.join(nodes.drop("long").withColumnRenamed("node", "b"), "b")
    dealt = rows.repartition("a", "part").sortWithinPartitions("a", "part", "looks")
    return dealt.mapInArrow(lambda batches: look_through(batches, num, den, partners), "a long, b long").distinct()


def link(docs: DataFrame, n: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id long, text string).

    Two texts link when den * (common shingles) >= num * (all shingles), with A-Z (ASCII only) taken as a-z. component_id is the smallest doc_id that links
    lead to; a text without words links with nothing and is its own component. Null texts are empty. Rows that repeat
    are components of one; a null doc_id never gives a component its name unless all its doc_ids are null, and then the
    component is null. An empty table gives no rows. Columns other than doc_id and text are not read.
    """
    return linked(docs, n, num, den, "doc_id", "n_shingles", "component_id")


def linked(docs: DataFrame, n: int, num: int, den: int, *wanted: str) -> DataFrame:
    """The wanted ones of link's columns, key (the text's hash) and component (its name among sets; null without words)."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    keyed = base.withColumn("key", F.xxhash64(F.coalesce("text", F.lit(""))))
    buckets = max(8, base.rdd.getNumPartitions())
    found, found_path = staged(match(emit(keyed, buckets, n, num, den), buckets, num, den), "found")
    paths = [found_path]
    meta = found.filter("kind = 2").select(F.col("a").alias("node"), F.when(F.col("known"), F.col("b")).alias("doc_id"), F.col("n").alias("n_shingles"), F.col("star").alias("key"))
    pairs, path = staged(found.filter("kind = 0").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("n").alias("n"), F.sum("star").alias("star"), F.min("spare").alias("least")), "pairs")
    paths.append(path)
    lists = found.filter("kind = 1").select("a", "b", "n", "band", "spare", "wide")

    # One text for each set that is in a pair or a long list.
    involved = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(lists.select(F.col("b").alias("node"))).distinct()
    sketches = [F.first(f"s{i}").alias(f"s{i}") for i in range(SKETCH)]
    keys = found.filter("kind = 2").withColumnRenamed("a", "node").join(involved, "node").groupBy("node").agg(F.min("star").alias("key"), F.min("extra").alias("low"), F.max("extra").alias("high"), F.first("n").alias("n"), *sketches)
    keys, path = staged(keys.withColumn("key", F.when(F.col("low") == F.col("high"), F.col("key")).otherwise(F.raise_error(F.lit("two sets have one 64-bit name")))).drop("low", "high"), "sets")
    paths.append(path)
    nodes = keys.drop("key").join(lists.groupBy(F.col("b").alias("node")).agg(F.count("*").alias("long")), "node", "left").withColumn("long", F.coalesce("long", F.lit(0)))
    nodes, path = staged(nodes, "nodes")
    paths.append(path)
    one = keyed.withColumn("check", F.xxhash64(F.lit(SHINGLE), F.coalesce("text", F.lit("")))).groupBy("key").agg(F.first("text").alias("text"), F.min("check").alias("low"), F.max("check").alias("high"))
    one = one.select(F.when(F.col("low") == F.col("high"), F.col("key")).otherwise(F.raise_error(F.lit("two texts have one 64-bit key"))).alias("key"), "text")
    texts, path = staged(one.join(keys.select("key", "node"), "key").select("node", "text"), "texts")
    paths.append(path)

    none = spark.createDataFrame([], "node long, component long")
    best = pairs.filter("star > 0").groupBy("b").agg(F.max_by(F.struct("a", "n", "least"), F.struct("star", "a")).alias("best")).select("best.a", "b", "best.n", "best.least")
    tried, path = staged(across(best, nodes, none, num, den), "tried")
    paths.append(path)
    links, path = staged(verified(tried, texts, n, num, den), "links")
    paths.append(path)
    label, path = components(links)
    paths.append(path)
    # First the pairs of short lists and the stars of long ones, then some pairs of long ones, then all.
    for partners in (-1, 4, None):
        if partners == -1:
            more = across(pairs, nodes, label, num, den)
        else:
            members, path = mixed_lists(lists, label)
            paths.append(path)
            more = long_list_pairs(members, nodes, num, den, partners)
        again, path = staged(more.join(tried, ["a", "b"], "left_anti"), "tried")
        paths.append(path)
        found_links, path = staged(verified(again, texts, n, num, den), "links")
        paths.append(path)
        tried, links = tried.unionByName(again), links.unionByName(found_links)
        label, path = components(links)
        paths.append(path)

    classes = meta.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    classes = classes.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = classes.join(classes.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("node", "component", "component_id")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    made, _ = staged(meta.join(named, "node", "left").withColumn("component_id", own).select(*wanted), "linked")
    discard(spark, *paths)
    return made


def keep_one(docs: DataFrame, n: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """The row with the smallest doc_id of each component; of rows that repeat with it, one. All rows without words and
    rows with a null doc_id stay, for they name no component."""
    rows = linked(columns(docs, "doc_id", "text"), n, num, den, "doc_id", "key", "n_shingles", "component").filter("n_shingles > 0 and doc_id is not null")
    # One (doc_id, key) a component stays; the rows that have it are told apart by nothing that was read, and one stays.
    texts = rows.groupBy("doc_id", "key", "component").agg(F.count("*").alias("n"))
    first = texts.groupBy("component").agg(F.min(F.struct("doc_id", "key")).alias("first")).select(F.col("first.doc_id").alias("doc_id"), F.col("first.key").alias("key"), F.lit(True).alias("stays"))
    fate, _ = staged(texts.join(first, ["doc_id", "key"], "left").filter("stays is null or n > 1").select(F.col("doc_id").alias("of_doc"), F.col("key").alias("of_key"), F.col("stays").isNotNull().alias("stays")), "fate")
    names = docs.columns
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    doc, short = F.col(f"c{names.index('doc_id')}").cast("long"), list(own.columns)
    keyed = own.withColumn("key", F.xxhash64(F.coalesce(f"c{names.index('text')}", F.lit(""))))
    same = (doc == F.col("of_doc")) & (F.col("key") == F.col("of_key"))
    kept = keyed.join(fate, same, "left_anti").select(*short)
    repeated = keyed.join(fate.filter("stays"), same, "left_semi")
    once = repeated.groupBy(doc.alias("doc"), "key").agg(F.first(F.struct(*short)).alias("row"))
    made = kept.unionByName(once.select(*[F.col(f"row.{c}").alias(c) for c in short]))
    return made.select(*[F.col(c).alias(names[i]) for i, c in enumerate(short)])


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents"))
