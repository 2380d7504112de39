"""Additive text scores over words and their character n-grams, in numpy.

A linear model over averaged subword features is a sum over words, so a word needs to be
scored once per task, whatever the number of its occurrences.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator, Sequence
from itertools import chain
from types import ModuleType

import numpy as np
from pyspark import TaskContext

_STEP = np.uint32(16_777_619)
_SPREAD = np.uint32(0x9E37_79B1)
# Texts are cut into tokens this many characters at a time, so a huge text needs no huge list.
PIECE_CHARS = 1 << 20


def live(key: str, make: Callable[[], object], most: int = 4):
    """The scorer of a model in use; a Python worker that runs several tasks keeps it for the next of them.

    Before a task makes a new one, those that only earlier tasks used go, so that a worker never holds
    the tables of several stages. This module's own globals are new in every task, so scorers are kept in a module by name.
    """
    kept = sys.modules.setdefault("_assayer_live", ModuleType("_assayer_live")).__dict__.setdefault("kept", {})
    context = TaskContext.get()
    task = context.taskAttemptId() if context else None
    if key not in kept:
        for old in [k for k, (last, _) in kept.items() if last != task]:
            del kept[old]
        while len(kept) >= most:
            del kept[next(iter(kept))]
        kept[key] = (task, make())
    kept[key] = (task, kept[key][1])
    return kept[key][1]


def pieces(text: str, break_at: re.Pattern, size: int = PIECE_CHARS) -> Iterator[str]:
    """The whole text in parts that end where ``break_at`` matches, so no token is cut."""
    start = 0
    while len(text) - start > size:
        found = break_at.search(text, start + size)
        if found is None:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:] if start else text


def subword_buckets(
    words: Sequence[str], n_min: int, n_max: int, bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """``(word index, bucket)`` of every feature: each n-gram of ``<word>`` and the word itself."""
    if not words:
        empty = np.zeros(0, np.int32)
        return empty, empty
    marked = "<" + "><".join(words) + ">"
    chars = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, words), np.int32, len(words)) + np.int32(2)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    # How many characters of its word follow each character.
    after = np.repeat(starts + sizes, sizes) - np.arange(len(chars), dtype=np.int32)
    shift = np.uint32(32 - bits)
    index, hashes = [], []
    rolling = np.zeros(len(chars), np.uint32)
    for n in range(1, min(n_max, len(chars)) + 1):
        rolling = rolling[: len(chars) - n + 1] * _STEP + chars[n - 1 :]
        if n >= n_min:
            inside = np.flatnonzero(after[: len(rolling)] >= n)
            index.append(owner[inside])
            hashes.append((rolling[inside] ^ np.uint32(n)) * _SPREAD)
    powers = np.full(int(sizes.max()), _STEP)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint32)
    whole = np.add.reduceat(chars * powers[after - 1], starts, dtype=np.uint32)
    index.append(np.arange(len(words), dtype=np.int32))
    hashes.append((whole ^ np.uint32(0xFF)) * _SPREAD)
    mixed = np.concatenate(hashes)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x846C_A68B)
    return np.concatenate(index), (mixed >> shift).astype(np.int32)


class WordSums:
    """Sums of word vectors over whole texts, with a bounded table of the words met so far."""

    def __init__(
        self,
        tokens: re.Pattern,
        break_at: re.Pattern,
        vectors_of: Callable[[list[str]], np.ndarray],
        width: int,
        max_words: int = 400_000,
    ):
        self.tokens, self.break_at = tokens, break_at
        self.vectors_of, self.width, self.max_words = vectors_of, width, max_words
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.vectors = np.zeros((1024, self.width), np.float64)

    def _learn(self, words: set[str]) -> None:
        new = words - self.places.keys()
        if len(self.places) + len(new) > self.max_words and self.places:
            self._forget()
            new = words
        if not new:
            return
        ordered = sorted(new)  # a fixed order, so that a retried task adds the same floats
        first = len(self.places)
        while len(self.vectors) < first + len(ordered):
            self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
        for at in range(0, len(ordered), 20_000):
            part = ordered[at : at + 20_000]
            self.vectors[first + at : first + at + len(part)] = self.vectors_of(part)
        self.places.update(zip(ordered, range(first, first + len(ordered))))

    def _add(self, lists: list[list[str]], rows: list[int], sums: np.ndarray, counts: np.ndarray) -> None:
        self._learn(set().union(*lists))
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(map(self.places.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
        full = np.flatnonzero(sizes)
        if len(full):
            starts = (np.cumsum(sizes) - sizes)[full]
            parts = np.add.reduceat(self.vectors[ids], starts, axis=0)
            np.add.at(sums, np.asarray(rows)[full], parts)
            np.add.at(counts, np.asarray(rows)[full], sizes[full])

    def __call__(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Vector sum and number of words of every text."""
        sums, counts = np.zeros((len(texts), self.width)), np.zeros(len(texts), np.int64)
        lists: list[list[str]] = []
        rows: list[int] = []
        waiting = 0
        for row, text in enumerate(texts):
            for part in pieces((text or "").lower(), self.break_at):
                lists.append(self.tokens.findall(part))
                rows.append(row)
                waiting += len(part)
                if waiting >= PIECE_CHARS:
                    self._add(lists, rows, sums, counts)
                    lists, rows, waiting = [], [], 0
        if lists:
            self._add(lists, rows, sums, counts)
        return sums, counts
