"""Words of whole Arrow text columns as numpy arrays, without a Python object for each word.

A word is a run of ASCII digits, ASCII letters (lower-cased) and all characters beyond ASCII. In UTF-8 every byte of
such a character is 0x80 or more, so words can be cut on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _fold() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for c in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
        table[c] = c
    for c in range(0x41, 0x5B):
        table[c] = c + 0x20
    return table


FOLD = _fold()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for every span, by prefix sums of a polynomial modulo 2^64."""
    n = len(values) + 1
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            grown = np.full(n, base, np.uint64)
            grown[0] = 1
            _powers[k] = np.multiply.accumulate(grown)
    sums = np.zeros(n, np.uint64)
    np.cumsum(values * _powers[0][: n - 1], dtype=np.uint64, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _powers[1][starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of several texts: byte places, hashes, and for text i the words first[i]:first[i + 1]."""

    folded: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def phrase(self, a: int, b: int) -> str:
        """Words a to b (exclusive) joined by blanks."""
        return " ".join(
            self.folded[s:e].tobytes().decode("utf-8", "replace")
            for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist(), strict=True)
        )


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(row, row behind, bytes, offsets) of consecutive rows of some ``limit`` bytes; a longer text comes alone.

    Null texts are empty texts. Memory that the rows needed is given back behind the last one: workers stay for later stages and operators.
    """
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        b = min(b, n)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; a run does not cross a text's end."""
    before = np.zeros(len(inside) + 1, bool)
    before[1:] = inside
    before[offsets] = False
    behind = np.zeros(len(inside) + 1, bool)
    behind[:-1] = inside
    behind[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~behind[1:]) + 1
    return starts, ends


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    folded = FOLD[data]
    starts, ends = runs(folded != 0, offsets)
    return Words(folded, starts, ends, span_hashes(folded, starts, ends), np.searchsorted(starts, offsets))


def grams(words: Words, size: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words, the text and the place in the text of each.

    ``whole`` adds, for a text with fewer words (but not none), all of its words as one gram.
    """
    n = len(words.hashes)
    text = np.repeat(np.arange(len(words.first) - 1), words.counts)
    place = np.arange(n) - words.first[text] if n else np.zeros(0, np.int64)
    out = np.zeros(max(n - size + 1, 0), np.uint64)
    for j in range(size):
        out = out * _BASE + words.hashes[j : n - size + 1 + j] if len(out) else out
    keep = np.flatnonzero(text[: len(out)] == text[size - 1 :][: len(out)]) if len(out) else np.zeros(0, np.int64)
    found = mixed(out[keep] + np.uint64(size)), text[keep], place[keep]
    if not whole:
        return found
    few = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if not len(few):
        return found
    short = np.array([_one(words.hashes[words.first[i] : words.first[i + 1]]) for i in few], np.uint64)
    order = np.argsort(np.concatenate([found[1], few]), kind="stable")
    return tuple(
        np.concatenate([a, b])[order] for a, b in zip(found, (short, few, np.zeros(len(few), np.int64)), strict=True)
    )


def _one(hashes: np.ndarray) -> int:
    out = np.zeros(1, np.uint64)
    for h in hashes:
        out = out * _BASE + h
    return int(mixed(out + np.uint64(len(hashes)))[0])
