"""Quality rules: counts of each text, and how far its character classes and common words diverge from its language.

The reference of a language is the mean of its documents' histograms, over all documents. A document is judged by the
Jensen-Shannon distance (base 2, so 0 to 1) of its own two histograms to that reference, each only from a minimum
length on. A mean of few documents strays by chance as well, by a divergence that falls with their number, and so much
more is allowed for, at every number alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import U64, columns, slices, table, texts_of

#: Common words by language.
COMMON_WORDS = {
    "de": "der die das und in zu den mit von für auf ist im dem nicht ein eine als auch es an er so dass kann aus ihr nach wird bei einer um am sind noch wie einem über".split(),
    "en": "the of and to in a is that for it as was with be by on not he this are or his from at which but have an had they you were their one all we can her has".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son cette ou mais comme on tout nous sa aux".split(),
}
#: ASCII characters by class. What isn't here is a control or, from the lead byte C2 on, no ASCII.
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\n\r\x0b\x0c",
    "stop": b".,;:?!'\"-()",
    "symbol": b"#*$%&|<>",
    "other": b"/\\@+=_~^`[]{}",
}
MIN_LETTERS, MIN_WORDS = 500, 100
#: A distance may be so large, and by what is divided by the root of the number of characters or words more: short
#: texts stray from their language by chance.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = (0.18, 1.5), (0.24, 0.8)
#: The divergence (squared distance) that a reference of one document allows for besides; divided by their number.
OF_REFERENCE = 0.5
N_CLASSES = len(CLASSES) + 2
LANGUAGE = re.compile(r"[a-z]{2,3}")


def class_table() -> np.ndarray:
    """Byte -> class; continuation bytes have one of their own, which isn't counted."""
    out = np.full(256, len(CLASSES), np.uint8)
    for k, members in enumerate(CLASSES.values()):
        out[list(members)] = k
    out[0x80:0xC0] = N_CLASSES - 1
    return out


def code_of(language: str | None) -> str:
    """A two- or three-letter code in lower case, "und" for anything else: bounds how many references there are."""
    found = (language or "").strip().lower().replace("_", "-").split("-")[0]
    return found if LANGUAGE.fullmatch(found) else "und"


def repeated_words(words: list[bytes]) -> int:
    """How many words stand in a 3-word window that the text has at least twice."""
    n = len(words)
    if n < 4:
        return 0
    names: dict[bytes, int] = {}
    word = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    # Numbers of pairs of words, then of windows, so that equal numbers are equal words.
    _, pair = np.unique(word[:-1] * len(names) + word[1:], return_inverse=True)
    window = pair[:-1] * len(names) + word[2:]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


class Histograms:
    """Of one text: character classes, and words that are common in the language (the last bin: any other)."""

    def __init__(self) -> None:
        self.classes = class_table()
        self.words = {code: {w.encode(): k for k, w in enumerate(words)} for code, words in COMMON_WORDS.items()}

    def of_classes(self, text: bytes) -> np.ndarray:
        return np.bincount(self.classes[np.frombuffer(text, np.uint8)], minlength=N_CLASSES)[: N_CLASSES - 1]

    def of_words(self, text: bytes, code: str) -> np.ndarray | None:
        bins = self.words.get(code)
        if bins is None:
            return None
        found = text.lower().translate(None, b".,;:?!\"()").split()
        get, other = bins.get, len(bins)
        return np.bincount(np.fromiter([get(w, other) for w in found], np.int64, len(found)), minlength=other + 1)


def share(x: np.ndarray) -> np.ndarray:
    return x / max(x.sum(), 1)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Root of the Jensen-Shannon divergence to base 2."""
    m = (p + q) / 2

    def against(x: np.ndarray) -> float:
        at = x > 0
        return float((x[at] * np.log2(x[at] / m[at])).sum())

    return float(np.sqrt(max(0.0, (against(p) + against(q)) / 2)))


def beyond(distance: float | None, limit: tuple[float, float], n: int, documents: float = float("inf")) -> bool:
    """Whether the distance of a text of n characters or words to a reference of so many documents is too large."""
    return distance is not None and distance**2 > (limit[0] + limit[1] / n**0.5) ** 2 + OF_REFERENCE / documents


def references(docs: DataFrame) -> dict[str, tuple[int, np.ndarray, np.ndarray | None]]:
    """Language code -> (documents, mean class histogram, mean common-word histogram), over all documents.

    Each task sums its documents by code, so a few rows a task are shuffled; there are at most 26**2 + 26**3 + 1 codes.
    Sums are of integers (millionths), so that their order doesn't matter.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Histograms()
        sums: dict[str, list] = {}
        for batch in slices(batches):
            for text, language in zip(texts_of(batch), batch.column("lang").to_pylist(), strict=True):
                if not text.strip():
                    continue
                code = code_of(language)
                words = made.of_words(text, code)
                both = np.concatenate([share(made.of_classes(text)), share(words) if words is not None else []])
                found = sums.setdefault(code, [0, 0])
                found[0] += 1
                found[1] = found[1] + np.rint(both * 1e6).astype(np.int64)
        rows = [(code, n, k, int(v)) for code, (n, total) in sums.items() for k, v in enumerate(total.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, (pa.string(), pa.int64(), pa.int32(), pa.int64()), strict=True)], names=["code", "n", "bin", "total"])

    parts = columns(docs, "lang", "text").mapInArrow(gather, "code string, n long, bin int, total long")
    out: dict[str, tuple[int, list]] = {}
    for r in parts.groupBy("code", "bin").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("code", "bin").collect():
        out.setdefault(r.code, (r.n, []))[1].append(r.total)
    k = N_CLASSES - 1
    return {c: (n, share(np.array(t[:k], float)), share(np.array(t[k:], float)) if t[k:] else None) for c, (n, t) in out.items()}


def assess(docs: DataFrame, max_class_distance: tuple[float, float] = MAX_CLASS_DISTANCE, max_word_distance: tuple[float, float] = MAX_WORD_DISTANCE, out: str = "quality") -> DataFrame:
    """The columns of docs, then `out` struct<n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    class_distance, word_distance (double, null where the text is too short or there is no reference), base_failed,
    kept (boolean)>.

    Null and empty texts have no words and fail. A null or odd `lang` is taken as its own language "und", which has
    no common words. Repeated rows are judged each for itself, to the same result; an empty table gives no rows.
    A column of docs that is called `out` already is an error, so choose another name then.
    """
    if out.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"docs has a column {out} already")
    known = docs.sparkSession.sparkContext.broadcast(references(docs))  # at most 26**2 + 26**3 + 1 codes with 50 numbers
    names = docs.columns

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Histograms()
        for batch in slices(batches):
            rows = []
            for text, language in zip(texts_of(batch), batch.column("lang").to_pylist(), strict=True):
                words = text.split()
                classes, code = made.of_classes(text), code_of(language)
                n, lines = len(words), [x for x in text.split(b"\n") if x.strip()]
                repeated = repeated_words(words)
                failed = n < 50 or 100 * repeated > 50 * n
                far = near = None
                documents, by_class, by_word = known.value.get(code, (0, None, None))
                if documents:
                    if classes.sum() >= MIN_LETTERS:
                        far = js_distance(share(classes), by_class)
                    if by_word is not None and n >= MIN_WORDS:
                        near = js_distance(share(made.of_words(text, code)), by_word)
                kept = not failed and not beyond(far, max_class_distance, int(classes.sum()), documents) and not beyond(near, max_word_distance, n, documents)
                rows.append((n, int(classes.sum() - classes[3]), int(classes[5]), len(lines) - len(set(lines)), repeated, far, near, failed, kept))
            kinds = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2
            fields = "n_words word_chars n_symbols n_dup_lines n_repeat_words class_distance word_distance base_failed kept".split()
            quality = pa.StructArray.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=fields)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), quality], names=[*names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(judge, schema + f", `{out}` struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,class_distance:double,word_distance:double,base_failed:boolean,kept:boolean>")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = assess(columns(table(spark, sf_dir, "documents"), "doc_id", "lang", "text"))
    return made.select("doc_id", *(f"quality.{c}" for c in "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept class_distance word_distance".split()))
