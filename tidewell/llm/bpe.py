"""BPE encoding and decoding by prefix-sharing trie traversal.

The encodings of all prefixes of a word hang together: for each prefix there is exactly one token t that ends it such
that the prefix without t has an encoding whose last token doesn't merge with t. So a trie of the distinct words needs
one state a node, the last token of the encoding of the path to it, and a depth-first walk sets the states of new nodes
from those of their ancestors. Words with a common prefix share its nodes, and its encoding is computed once.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import columns, slices, table, texts_of
from tidewell.llm.packing import default_vocabulary
from tidewell.llm.tokens import Pieces, load


def byte_alphabet() -> dict[str, int]:
    """Character of the byte-level alphabet -> byte: printable bytes stand for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    out.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    return out


class Trie:
    """Words as paths; node 0 is the root. `bound`: nodes kept between words at most."""

    def __init__(self, path: str, bound: int = 600_000):
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        letters = byte_alphabet()
        spell = lambda token: bytes(letters[c] for c in token)
        self.special = {x["content"].encode(): x["id"] for x in made["added_tokens"]}
        ids = {spell(token): i for token, i in made["model"]["vocab"].items() if token.encode() not in self.special}
        self.rank = {}
        for r, pair in enumerate(made["model"]["merges"]):
            left, right = map(spell, pair if isinstance(pair, list) else pair.split(" "))
            self.rank[ids[left], ids[right]] = (r, ids[left + right])
        self.text = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.byte = [ids[bytes([b])] for b in range(256)]
        # Only a token that its own spelling encodes to can end an encoding.
        self.ids = {t: i for t, i in ids.items() if self.merged(t) == [i]}
        self.longest = max(map(len, self.ids))
        self.apart: dict[tuple[int, int], bool] = {}
        self.bound = bound
        self.reset()

    def reset(self) -> None:
        self.child: list[dict[int, int] | None] = [{}]
        self.last = [-1]  # token that ends the encoding of the path here
        self.back = [-1]  # node where that token begins
        self.count = [0]

    def merged(self, word: bytes) -> list[int]:
        """The definition: merge the pair of lowest rank, leftmost first, until none is left. For short strings."""
        out = [self.byte[b] for b in word]
        while len(out) > 1:
            best, at = min(((self.rank.get(p, (1 << 60, 0))[0], k) for k, p in enumerate(zip(out, out[1:], strict=False))), default=(1 << 60, 0))
            if best == 1 << 60:
                break
            out[at : at + 2] = [self.rank[out[at], out[at + 1]][1]]
        return out

    def stays_apart(self, left: int, right: int) -> bool:
        key = (left, right)
        found = self.apart.get(key)
        if found is None:
            if len(self.apart) > 1_000_000:
                self.apart.clear()
            found = self.apart[key] = self.merged(self.text[left] + self.text[right]) == [left, right]
        return found

    def insert(self, word: bytes) -> int:
        """The node of the word; states of new nodes are set on the way down."""
        child, last, back, count, ids = self.child, self.last, self.back, self.count, self.ids
        node, path = 0, [0]
        for depth, letter in enumerate(word, 1):
            below = child[node]
            if below is None:
                below = child[node] = {}
            into = below.get(letter)
            if into is None:
                for size in range(min(depth, self.longest), 0, -1):
                    token = ids.get(word[depth - size : depth])
                    if token is not None:
                        start = path[depth - size]
                        if start == 0 or self.stays_apart(last[start], token):
                            break
                into = below[letter] = len(last)
                child.append(None)
                last.append(token)
                back.append(start)
                count.append(count[start] + 1)
            path.append(into)
            node = into
        return node

    def tokens(self, node: int) -> list[int]:
        out = []
        while node:
            out.append(self.last[node])
            node = self.back[node]
        return out[::-1]

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Encodings of distinct words. Sorted, so that the walk goes depth first."""
        if len(self.last) > self.bound:
            self.reset()
        out: dict[bytes, list[int]] = {}
        for word in sorted(words):
            out[word] = self.tokens(self.insert(word))
            if len(self.last) > 4 * self.bound:
                self.reset()
        return [out[w] for w in words]


class Codec(Pieces):
    """Texts to ids (little-endian 32-bit integers) and back. Pieces between spaces are split into words once."""

    def __init__(self, path: str, bound: int = 1_000_000):
        super().__init__(self.through_trie, self.letter_words, bound)
        self.trie, self.split, self.letters = Trie(path), load(path).pre_tokenizer, byte_alphabet()

    def split_words(self, piece: bytes) -> list[bytes]:
        """The words of the vocabulary's own splitter; special tokens are words of their own."""
        for special in self.trie.special:
            if special in piece:
                left, right = piece.split(special, 1)
                return [*self.split_words(left), special, *self.split_words(right)]
        letters = self.letters
        return [bytes([letters[c] for c in word]) for word, _ in self.split.pre_tokenize_str(piece.decode())] if piece else []

    def through_trie(self, pieces: list[bytes]) -> list[bytes]:
        special, cut = self.trie.special, [self.split_words(p) for p in pieces]
        plain = list(dict.fromkeys(w for words in cut for w in words if w not in special))
        made = dict(zip(plain, self.trie.encode(plain), strict=True)) | {w: [i] for w, i in special.items()}
        return [np.array([i for w in words for i in made[w]], "<i4").tobytes() for words in cut]

    def letter_words(self, found: list[bytes]) -> list[bytes]:
        """Each with the space before it is one word."""
        return [array("i", ids).tobytes() for ids in self.trie.encode([b" " + w for w in found])]

    def decode(self, ids: np.ndarray) -> str:
        text = self.trie.text
        return b"".join([text.get(i, b"") for i in ids.tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    """One a worker process, for all its tasks: what is remembered only saves time."""
    return Codec(path)


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, ids array<int>, decoded string, one row per row of docs.

    Null and empty texts give no ids and an empty string. Repeated rows and null doc_ids stay as they are; an empty
    table gives no rows. Columns other than doc_id and text are not read.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made_codec = codec(path)
        for batch in slices(batches):
            made = made_codec.encode(texts_of(batch))
            sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("<i4")
            flat = np.frombuffer(b"".join(made), "<i4")
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            decoded = pa.array([made_codec.decode(np.frombuffer(x, "<i4")) for x in made], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, decoded], names=["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return columns(docs, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = round_trip(table(spark, sf_dir, "documents"))
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
