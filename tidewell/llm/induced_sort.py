"""Suffix sorting of one shard by induction, with queues on disk.

A suffix that is larger than its right neighbour is of type L, else of type S; an S suffix right of an L suffix is a
seed. The order of the seeds induces that of all L suffixes, and that the order of all S suffixes: whenever a suffix
leaves the queue, its left neighbour enters it under its first letter, behind all that entered under that letter
before. The queue gives suffixes back letter by letter; what it holds beyond its share of memory lies on disk.

The seeds themselves are sorted by one induction from unsorted seeds, which sorts the strings between seeds, and then,
where such strings repeat, by doubling over their names. That goes only as far as `width` letters: suffixes that agree
in so many stay in any order. The common prefix of neighbours, cut off at `width`, is read off the text.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np


class DiskQueue:
    """Suffixes by letter, first in, first out under a letter. `memory`: bytes held before the rest goes to disk."""

    def __init__(self, letters: int, memory: int):
        self.parts: list[list[np.ndarray | tuple[int, int]]] = [[] for _ in range(letters)]
        self.held, self.memory, self.file = 0, memory, None

    def push(self, letters: np.ndarray, suffixes: np.ndarray) -> None:
        if not len(suffixes):
            return
        if letters[0] == letters[-1] and (letters == letters[0]).all():
            self._keep(int(letters[0]), suffixes)
            return
        order = np.argsort(letters, kind="stable")
        letters, suffixes = letters[order], suffixes[order]
        starts = np.flatnonzero(np.diff(letters, prepend=letters[0] - 1 if letters[0] else letters[0] + 1))
        for i, j in zip(starts, [*starts[1:], len(letters)], strict=True):
            self._keep(int(letters[i]), suffixes[i:j])

    def _keep(self, letter: int, suffixes: np.ndarray) -> None:
        if self.held + suffixes.nbytes > self.memory:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.seek(0, 2)
            at = self.file.tell()
            self.file.write(suffixes.tobytes())
            self.parts[letter].append((at, len(suffixes)))
        else:
            self.held += suffixes.nbytes
            self.parts[letter].append(suffixes)

    def pop(self, letter: int) -> Iterator[np.ndarray]:
        for part in self.parts[letter]:
            if isinstance(part, tuple):
                self.file.seek(part[0])
                yield np.frombuffer(self.file.read(part[1] * 8), np.int64)
            else:
                self.held -= part.nbytes
                yield part
        self.parts[letter] = []

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class InducedSort:
    """text: letters as uint16 above 0; `width` as above; `memory` for each queue. order: suffixes, smallest first."""

    def __init__(self, text: np.ndarray, width: int, memory: int = 1 << 26):
        self.text = np.append(text, np.uint16(0))  # the end is smaller than any letter
        self.width, self.memory = width, memory
        t, n = self.text, len(self.text)
        self.letters = int(t.max()) + 1
        # S if the next unlike letter is larger; the end is S.
        change = np.flatnonzero(t[1:] != t[:-1])
        up = t[change] < t[change + 1]
        length = np.diff(np.append(-1, change))
        self.small = np.append(np.repeat(up, length), True)
        self.seeds = np.flatnonzero(self.small[1:] & ~self.small[:-1]) + 1

    def induce(self, seeds: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """L suffixes and S suffixes by letter, from seeds in order. S suffixes are largest first."""
        t, small = self.text, self.small
        large_queue, seed_queue = DiskQueue(self.letters, self.memory), DiskQueue(self.letters, self.memory)
        seed_queue.push(t[seeds], seeds)
        large: list[np.ndarray] = []
        for letter in range(self.letters):
            out, turn = [], large_queue.pop(letter)
            while turn := [x for x in turn if len(x)]:
                out += turn
                # Those that enter under the letter itself come behind all that are there, as in one pass over the queue.
                behind = []
                for now in turn:
                    left = now[now > 0] - 1
                    left = left[~small[left]]
                    same = t[left] == letter
                    large_queue.push(t[left[~same]], left[~same])
                    behind.append(left[same])
                turn = behind
            large.append(np.concatenate(out) if out else np.empty(0, np.int64))
            for now in seed_queue.pop(letter):
                left = now[now > 0] - 1
                left = left[~small[left]]
                large_queue.push(t[left], left)
        large_queue.close()
        seed_queue.close()
        small_queue = DiskQueue(self.letters, self.memory)
        smalls: list[np.ndarray] = [np.empty(0, np.int64)] * self.letters
        for letter in range(self.letters - 1, -1, -1):
            out, turn = [], small_queue.pop(letter)
            while turn := [x for x in turn if len(x)]:
                out += turn
                behind = []
                for now in turn:
                    left = now[now > 0] - 1
                    left = left[small[left]]
                    same = t[left] == letter
                    small_queue.push(t[left[~same]], left[~same])
                    behind.append(left[same])
                turn = behind
            smalls[letter] = np.concatenate(out) if out else np.empty(0, np.int64)
            now = large[letter][::-1]
            left = now[now > 0] - 1
            left = left[small[left]]
            small_queue.push(t[left], left)
        small_queue.close()
        return large, smalls

    def sorted_seeds(self) -> np.ndarray:
        seeds, t = self.seeds, self.text
        if len(seeds) < 2:
            return seeds
        _, smalls = self.induce(seeds)
        is_seed = np.zeros(len(t), bool)
        is_seed[seeds] = True
        ranked = np.concatenate([x[::-1] for x in smalls])
        ranked = ranked[is_seed[ranked]]
        end = len(t) - 1
        if ranked[0] != end:  # the end itself is induced from nothing
            ranked = np.append(end, ranked[ranked != end])
        length = np.zeros(len(t), np.int64)
        length[seeds[:-1]] = np.diff(seeds) + 1
        length[end] = 1
        a, b = ranked[:-1], ranked[1:]
        same = length[a] == length[b]
        left = np.flatnonzero(same)
        at = 0
        while len(left):
            more = length[a[left]] > at
            left = left[more]
            equal = t[a[left] + at] == t[b[left] + at]
            same[left[~equal]] = False
            left = left[equal]
            at += 1
        name = np.zeros(len(t), np.int64)
        name[ranked] = np.concatenate([[0], np.cumsum(~same)])
        rank = name[seeds]
        step = 1
        while int(rank.max()) + 1 < len(rank) and step * 2 <= max(4, 2 * self.width):
            after = np.zeros(len(rank), np.int64)
            after[:-step] = rank[step:] + 1
            _, rank = np.unique(rank * (len(rank) + 1) + after, return_inverse=True)
            step *= 2
        return seeds[np.argsort(rank, kind="stable")]

    def order(self) -> np.ndarray:
        if len(self.text) == 1:
            return np.empty(0, np.int64)
        large, smalls = self.induce(self.sorted_seeds())
        out = np.concatenate([x for pair in zip(large, (s[::-1] for s in smalls), strict=True) for x in pair])
        return out[out < len(self.text) - 1]


def equal_neighbours(raw: bytes, order: np.ndarray, width: int) -> np.ndarray:
    """Whether each suffix has `width` letters in common with the one before it. raw: the text as bytes; each suffix in
    order has so many."""
    padded = np.frombuffer(raw + bytes(8), np.uint8)
    eight = np.lib.stride_tricks.as_strided(padded, (len(raw) + 1, 8), (1, 1))
    same = np.zeros(len(order), bool)
    left = np.arange(1, len(order))
    for at in [*range(0, width - 8, 8), width - 8]:
        if not len(left):
            break
        a = np.ascontiguousarray(eight[order[left] + at]).view(np.uint64).ravel()
        b = np.ascontiguousarray(eight[order[left - 1] + at]).view(np.uint64).ravel()
        left = left[a == b]
    same[left] = True
    return same
