"""Token ids of whole texts, with the encodings of pieces between spaces remembered.

A piece is a run without ASCII white space together with the white space before it. Both vocabularies split text
wherever white space begins after a visible character, so the ids of a text are those of its pieces, joined. A text with
other white space (no-break space, line separator, control separators) is one piece instead.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: The ASCII separators that only some call space; lead bytes of white space outside ASCII, and how such begins.
ODD_ASCII = (b"\x1c", b"\x1d", b"\x1e", b"\x1f")
ODD_LEAD = (b"\xc2", b"\xe1", b"\xe2", b"\xe3", b"\xef")
ODD_SPACE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe1\xa0", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80", b"\xef\xbb")
PIECE = re.compile(rb"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: By byte: ASCII letters; the second bytes of the letters from U+00C0 to U+00FF, which 0xC3 begins; ASCII punctuation.
LETTER, LETTER_END, MARK = (np.isin(np.arange(256), list(x)) for x in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", bytes({*range(0x80, 0xC0)} - {0x97, 0xB7}), PUNCTUATION))
RARE = (b"\t", b"\r", b"\x0b", b"\x0c")
RUNS = (b"  ", b" \n", b"\n ", b"\n\n")


def odd(text: bytes) -> bool:
    return any(x in text for x in ODD_ASCII) or not text.isascii() and any(x in text for x in ODD_LEAD) and any(x in text for x in ODD_SPACE)


def load(path: str):
    """The tokenizer in the file, without truncation or padding, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.LargeBinaryArray:
    """The data cut at the offsets (0 first, its length last), without a copy."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def views(found: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of strings."""
    _, offsets, data = found.buffers()
    return np.frombuffer(data or b"", np.uint8), np.frombuffer(offsets, np.int64)[found.offset : found.offset + len(found) + 1]


def kinds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each string (of valid UTF-8, none empty), the bytes of Latin letters behind its first byte if it is a space,
    Latin letters and then nothing but ASCII punctuation, or else 0; and its bytes of punctuation, which then are all
    behind the letters."""
    letter, mark = LETTER[data], MARK[data]
    two = (data[:-1] == 0xC3) & LETTER_END[data[1:]]
    letter[:-1] |= two
    letter[1:] |= two
    back = np.zeros(len(data), bool)
    back[1:] = mark[:-1] & letter[1:]
    n_letters, n_marks, n_back = (np.add.reduceat(x, offsets[:-1], dtype=np.int64) for x in (letter, mark, back))
    fit = (data[offsets[:-1]] == 32) & (n_back == 0) & (n_letters + n_marks + 1 == np.diff(offsets))
    return np.where(fit, n_letters, 0), n_marks


class Pieces:
    """Joins what `learn` makes of a text's pieces: learn(pieces) -> bytes of each. `bound`: pieces remembered at most.

    `words` does the same for pieces that are a space and Latin letters; there are many of them, so it may be faster.
    Each unlike piece of a call is looked up once, however often it occurs.
    """

    def __init__(self, learn: Callable[[list[bytes]], list[bytes]], words: Callable[[list[bytes]], list[bytes]] | None, bound: int):
        self.learn, self.words, self.bound = learn, words or (lambda found: learn([b" " + w for w in found])), bound
        self.known: dict[bytes, bytes] = {}

    def _whole(self, units: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """Of unlike pieces that aren't cut further."""
        known, names = self.known, units.to_numpy(zero_copy_only=False).tolist()
        made = [*map(known.get, names)]
        new = np.array([x is None for x in made])
        if new.any():
            n_letters, n_marks = kinds(*views(units))
            latin = (n_letters > 0) & (n_marks == 0)
            for rows, learn in ((new & latin, lambda found: self.words([w[1:] for w in found])), (new & ~latin, self.learn)):
                at = np.flatnonzero(rows).tolist()
                found = [names[i] for i in at]
                for i, name, x in zip(at, found, learn(found), strict=True):
                    made[i] = known[name] = x
        return pa.array(made, pa.large_binary())

    def _cut(self, pieces: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """Of unlike pieces. Letters and the ASCII punctuation after them never share a token, so each is learnt by itself."""
        data, offsets = views(pieces)
        n_letters, n_marks = kinds(data, offsets)
        halves = 1 + ((n_letters > 0) & (n_marks > 0))
        first = np.concatenate([[0], np.cumsum(halves)])
        edges = np.repeat(offsets, np.append(halves, 1))
        edges[first[1:][halves == 2] - 1] += 1 + n_letters[halves == 2]
        return through(data, edges, first, self._whole)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > self.bound:
            self.known.clear()
        out, plain = [b""] * len(texts), []
        for row, text in enumerate(texts):
            if odd(text):
                out[row] = self.learn([text])[0]
            elif any(x in text for x in RARE) or any(x in text for x in RUNS):
                found = PIECE.findall(text)
                unlike = [*dict.fromkeys(found)]
                out[row] = b"".join(map(dict(zip(unlike, self.learn(unlike), strict=True)).__getitem__, found))
            elif text:
                plain.append(row)
        if plain:
            data = np.frombuffer(b"".join([texts[row] for row in plain]), np.uint8)
            starts = np.cumsum([0] + [len(texts[row]) for row in plain])
            edge = (data == 32) | (data == 10)
            edge[starts[:-1]] = True
            edges = np.append(np.flatnonzero(edge), len(data))
            made = through(data, edges, np.searchsorted(edges, starts), self._cut)
            for row, x in zip(plain, made.to_pylist(), strict=True):
                out[row] = x
        return out


def through(data: np.ndarray, edges: np.ndarray, first: np.ndarray, make: Callable[[pa.LargeBinaryArray], pa.LargeBinaryArray]) -> pa.LargeBinaryArray:
    """The data cut at the edges, what `make` makes of each unlike string, joined from each edge of the numbers `first`
    to the next."""
    coded = strings(data, edges).dictionary_encode()
    made, ends = views(make(coded.dictionary).take(coded.indices))
    return strings(made, ends[first])


def ranked(model: dict) -> Callable[[list[bytes]], list[bytes]]:
    """Encodes words of Latin letters that a space precedes, by merge ranks: the merges are the file's, the engine that
    applies them is a faster one.

    A vocabulary with an end-of-word suffix joins the suffix to the last letter before any merge. Here a zero byte
    stands for the suffix, and the 256 pairs with it rank first. Such vocabularies are lower case.
    """
    import tiktoken

    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): bytes([b]) for b in plain} | {chr(256 + i): bytes([b]) for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    ending = model.get("end_of_word_suffix")

    def spell(token: str) -> bytes:
        whole = ending is not None and token.endswith(ending)
        return b"".join(letters[c] for c in (token[: -len(ending)] if whole else token)) + (b"\0" if whole else b"")

    vocabulary, ranks, ids = model["vocab"], {}, []

    def rank(token: str) -> None:
        spelt = spell(token)
        if spelt in ranks:
            raise ValueError("two merges spell one token")
        ranks[spelt] = len(ids)
        ids.append(vocabulary[token])

    # A space byte may stand alone only where words keep their space; where the suffix is in use, byte 0 is the suffix.
    for c in letters:
        if ending is None or letters[c] != b"\0":
            rank(c)
    if ending is not None:
        ranks[b"\0"] = len(ids)
        ids.append(-1)
        for c in letters:
            if letters[c] != b"\0":
                rank(c + ending)
    for merge in model["merges"]:
        rank("".join(merge if isinstance(merge, list) else merge.split(" ")))
    engine = tiktoken.Encoding("ranked", pat_str="[^\\x00]+\\x00" if ending else " [^ ]+", mergeable_ranks=ranks, special_tokens={})
    number = np.array(ids)
    edge = np.zeros(len(ids), bool)
    edge[[r for spelt, r in ranks.items() if (spelt.endswith(b"\0") if ending else spelt.startswith(b" "))]] = True

    def words(found: list[bytes]) -> list[bytes]:
        """All in one text; a token that ends in the suffix ends a word, or else one that begins with a space begins it."""
        if not found:
            return []
        text = (b"\0".join(found) + b"\0").decode().lower() if ending else " " + b" ".join(found).decode()
        made = np.array(engine.encode_ordinary(text))
        at = np.flatnonzero(edge[made])
        at = (at + 1 if ending else np.append(at[1:], len(made))) * 4
        raw = number[made].astype("<u4").tobytes()
        return [raw[i:j] for i, j in zip([0, *at[:-1].tolist()], at.tolist(), strict=True)]

    return words


class Encoder(Pieces):
    """UTF-8 texts -> ids as little-endian unsigned 32-bit integers. Pieces go through the tokenizers library, but for
    words of Latin letters, of which there are so many that they go through `ranked`."""

    def __init__(self, path: str, bound: int = 1_000_000):
        tokenizer = load(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]

        def learn(pieces: list[bytes]) -> list[bytes]:
            return [np.array(x.ids, "<u4").tobytes() for x in tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]

        self.size = tokenizer.get_vocab_size()
        super().__init__(learn, ranked(model), bound)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One a worker process, for all its tasks: what is remembered only saves time."""
    return Encoder(path)
