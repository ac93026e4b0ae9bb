"""Toxicity by a convolutional text classifier in numpy.

A word's embedding is the sum of rows of one hashed table: of the word and of its beginnings, as far as enough of the
training texts have them; other words share one row, since chance would put them beside telling words. Filters of several widths run over the embeddings, the largest value of each over
the text counts, and a logistic unit scores these. Per language, which common words of the text tell, the threshold is
put where it parts validation texts best, and scores are moved so that each threshold comes to 0.7.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import slices, table, texts_of
from tidewell.llm.quality import COMMON_WORDS

#: Training sample: labelled rows of either kind at most, and bytes of a text at most. Scoring reads whole texts.
SAMPLE, SAMPLE_BYTES = 5_000, 20_000
BUCKETS, SIZE, FILTERS, WIDTHS = 1 << 16, 8, 8, (1, 2, 3)
PAD, UNKNOWN, FIRST = 0, 1, 2
THRESHOLD, MIN_DOCUMENTS, MIN_LANGUAGE, DECAY = 0.7, 5, 40, 2e-3
#: Bytes of a word's beginnings.
BEGINNINGS = (5, 7)
DROP, FREEDOM = 0.15, 1.5
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"
MARKS = {w.encode(): k for k, words in enumerate(COMMON_WORDS.values()) for w in words if sum(w in v for v in COMMON_WORDS.values()) == 1}


def words_of(text: bytes) -> list[bytes]:
    return text.decode("utf-8", "replace").lower().encode().translate(None, PUNCTUATION).split()


def language(words: list[bytes]) -> int:
    """Number of the language whose own common words the text has most of; the number of languages if none."""
    get = MARKS.get
    found = Counter(k for k in map(get, words) if k is not None)
    return max(found, key=lambda k: (found[k], -k)) if found else len(COMMON_WORDS)


def parts_of(word: bytes) -> list[bytes]:
    return [word, *(word[:n] + b"-" for n in BEGINNINGS if len(word) > n)]


class Codes(dict):
    """Word -> the rows of its parts, 16 bits each. What it has met it keeps, up to a bound, to save time."""

    def __init__(self, known: dict[bytes, int], bound: int = 500_000):
        super().__init__()
        self.known, self.bound = known, bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        first, *rest = parts_of(word)
        code = self.known.get(first, UNKNOWN)
        for k, part in enumerate(rest, 1):
            code |= self.known.get(part, PAD) << 16 * k
        self[word] = code
        return code


@dataclass
class Classifier:
    known: dict[bytes, int]
    table: np.ndarray = field(repr=False)
    filters: list[np.ndarray] = field(repr=False)  # of each width: width * SIZE rows, FILTERS columns
    bias: np.ndarray = field(repr=False)
    weight: np.ndarray = field(repr=False)
    offset: float
    thresholds: np.ndarray  # logits by language
    codes: Codes | None = None

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Rows of each word's parts, with padding behind, so that each width has a place in every text."""
        if self.codes is None:
            self.codes = Codes(self.known)
        code = np.zeros(len(words) + max(WIDTHS), np.int64)
        code[: len(words)] = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        return np.stack([code >> 16 * k & 0xFFFF for k in range(1 + len(BEGINNINGS))], axis=1)

    def pooled(self, ids: list[np.ndarray], where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Largest value of each filter in each text, before the rectifier, and the places where they stand."""
        sizes = np.array([len(x) for x in ids])
        starts = np.cumsum(sizes) - sizes
        rows = np.concatenate(ids)
        vectors = self.table[rows[:, 0]]
        for k in range(1, rows.shape[1]):
            vectors += self.table[rows[:, k]]
        most, places = [], []
        for width, kernel in zip(WIDTHS, self.filters, strict=True):
            out = vectors[: len(vectors) - width + 1] @ kernel[:SIZE]
            for j in range(1, width):
                out += vectors[j : len(vectors) - width + 1 + j] @ kernel[j * SIZE : (j + 1) * SIZE]
            for a in (starts + sizes)[:-1]:  # no window crosses from one text to the next
                out[a - width + 1 : a] = -np.inf
            most.append(np.maximum.reduceat(out, starts, axis=0))
            if where:
                places.append(np.array([out[a : a + n].argmax(axis=0) + a for a, n in zip(starts, sizes, strict=True)]))
        return np.hstack(most) + self.bias, np.hstack(places) if where else None

    def logits(self, ids: list[np.ndarray]) -> np.ndarray:
        return np.maximum(self.pooled(ids)[0], 0) @ self.weight + self.offset

    def scores(self, texts: list[bytes]) -> np.ndarray:
        words = [words_of(t) for t in texts]
        z = self.logits([self.ids(w) for w in words]) - self.thresholds[[language(w) for w in words]]
        return 1 / (1 + np.exp(-np.clip(z + np.log(THRESHOLD / (1 - THRESHOLD)), -60, 60)))


def bucket(word: bytes) -> int:
    import xxhash

    return FIRST + xxhash.xxh3_64_intdigest(word) % (BUCKETS - FIRST)


def fit(rows: list[tuple[bytes, int]], epochs: int = 20, rate: float = 0.02, batch: int = 64, seed: int = 7) -> Classifier:
    """rows: (text, 0 or 1). A fifth of them, chosen by the seed, sets the thresholds and isn't trained on."""
    rng = np.random.default_rng(seed)
    cut = [(words_of(t), y) for t, y in rows]
    count = Counter(x for words, _ in cut for x in {x for w in set(words) for x in parts_of(w)})
    model = Classifier(
        {x: bucket(x) for x, n in sorted(count.items()) if n >= max(MIN_DOCUMENTS, len(cut) // 400)},
        rng.normal(0, 0.02, (BUCKETS, SIZE)).astype(np.float32), [rng.normal(0, 0.3, (w * SIZE, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS), np.float32), np.abs(rng.normal(0, 0.3, FILTERS * len(WIDTHS))).astype(np.float32), 0.0, np.zeros(len(COMMON_WORDS) + 1),
    )
    model.table[PAD] = 0
    y = np.array([x for _, x in cut], np.float32)
    if not len(y) or y.min() == y.max():
        model.weight[:] = 0
        model.offset = 6.0 if len(y) and y[0] else -6.0
        return model
    ids = [model.ids(words) for words, _ in cut]
    mixed = rng.permutation(len(ids))
    check, train = mixed[: len(ids) // 5], mixed[len(ids) // 5 :]
    balance = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    offset = np.zeros(1, np.float32)
    state = [model.table, *model.filters, model.bias, model.weight, offset]
    first, second = ([np.zeros_like(x) for x in state] for _ in range(2))
    turn = 0
    for epoch in range(epochs):
        order = rng.permutation(train)
        for some in np.array_split(order, max(1, len(order) // batch)):
            part = [np.where(rng.random((len(ids[i]), 1)) < DROP, PAD, ids[i]) for i in some]
            pre, places = model.pooled(part, True)
            hidden = np.maximum(pre, 0)
            off = ((1 / (1 + np.exp(-np.clip(hidden @ model.weight + offset[0], -30, 30))) - y[some]) * balance[some] / len(some)).astype(np.float32)
            back = off[:, None] * model.weight * np.where(pre > 0, 1, 0.05).astype(np.float32)
            all_ids = np.concatenate(part)
            slopes = [np.zeros_like(x) for x in state]
            for k, (width, kernel) in enumerate(zip(WIDTHS, model.filters, strict=True)):
                mine, at = back[:, k * FILTERS : (k + 1) * FILTERS], places[:, k * FILTERS : (k + 1) * FILTERS]
                for j in range(width):
                    rows_of, piece = all_ids[at + j], slice(j * SIZE, (j + 1) * SIZE)
                    slopes[1 + k][piece] = np.einsum("df,dfs->sf", mine, model.table[rows_of].sum(axis=2))
                    change = mine[:, :, None] * kernel[piece].T[None]
                    np.add.at(slopes[0], rows_of, change[:, :, None])
            slopes[0][PAD] = 0
            slopes[-3], slopes[-2], slopes[-1][0] = back.sum(axis=0), hidden.T @ off, off.sum()
            turn += 1
            step = rate * (1 - 0.9 * epoch / epochs) * (1 - 0.99**turn) ** 0.5 / (1 - 0.9**turn)
            for x, slope, m1, m2 in zip(state, slopes, first, second, strict=True):
                m1 += 0.1 * (slope - m1)
                m2 += 0.01 * (slope * slope - m2)
                x -= step * m1 / (np.sqrt(m2) + 1e-5)
            model.table *= 1 - DECAY
    model.offset = float(offset[0])
    model.codes = None
    tongues = np.array([language(cut[i][0]) for i in check])
    z = np.concatenate([model.logits([ids[i] for i in some]) for some in np.array_split(check, max(1, len(check) // 256))])
    whole = best_threshold(z, y[check])
    for k in range(len(model.thresholds)):
        own = tongues == k
        enough = own.sum() >= MIN_LANGUAGE and 5 <= y[check][own].sum() < own.sum()
        # Few validation texts move a language's threshold only so far from that of all.
        model.thresholds[k] = np.clip(best_threshold(z[own], y[check][own]), whole - FREEDOM, whole + FREEDOM) if enough else whole
    return model


def best_threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The middle of the widest gap among those logits that part the labels with the best F1."""
    order = np.argsort(z)
    z, y = z[order], y[order]
    positives = y.sum()
    below = np.concatenate([[0], np.cumsum(y)])
    n = len(z)
    hits = positives - below
    f1 = 2 * hits / np.maximum(1, positives + n - np.arange(n + 1))
    edge = np.concatenate([[z[0] - 2], z, [z[-1] + 2]])
    gap = np.diff(edge)
    top = np.flatnonzero(f1 >= f1.max() - 1e-9)
    at = top[np.argmax(gap[top])]
    return float((edge[at] + edge[at + 1]) / 2)


def held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Classifier:
    """Fits on rows whose crc32(doc_id as text) modulo 3 isn't 1: up to `sample` rows of either label, the first in the
    order of a hash of doc_id, with texts of up to `sample_bytes` bytes. Rows with another label than 0 or 1, without
    text, or without doc_id are left out; of rows that repeat with a doc_id, the least text counts."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select("doc_id", "text").filter(f"doc_id is not null and octet_length(text) between 1 and {sample_bytes}")
    chosen = []
    for label in (0, 1):
        ids = usable.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen.append(ids)
    # A doc_id that repeats is one row: 2 * sample rows at most reach the driver.
    rows = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    return fit([(r.text.encode(), r.toxic) for r in sorted(rows, key=lambda r: (r.doc_id, r.text))])


def score(docs: DataFrame, model: Classifier, out: str = "toxicity") -> DataFrame:
    """The columns of docs, then `out` double from 0 to 1; toxic from 0.7 on.

    Null and empty texts get the score of no words. Repeated rows get the same score; an empty table gives no rows. A
    column of docs that is called `out` already is an error, so choose another name then.
    """
    names = docs.columns
    if out.lower() in (n.lower() for n in names):
        raise ValueError(f"docs has a column {out} already")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size, and words of the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.scores(texts_of(batch)), pa.float64())], names=[*names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, schema + f", `{out}` double")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return made.select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
