"""Folded words and word runs, as the likeness of two texts takes them."""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib

import numpy as np

#: Longest runs of letters and digits.
WORD = re.compile(r"[^\W_]+")
#: Words in a run, and the least share of common runs (fixed by the test data's definition of likeness).
RUN = 3
LIKE = 0.60


def fold(text: str) -> str:
    """Compatibility decomposition without combining marks, in lower case."""
    if not text.isascii():
        text = "".join([c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)])
    return text.lower()


def words(text: str) -> list[str]:
    """The folded words.  Letters and digits only: what decomposition leaves of marks or numerals stays out."""
    return WORD.findall(fold(text))


#: What can't be parted by folding: ASCII letters and digits with whatever isn't ASCII among them.
RAW = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


class WordHash:
    """The folded words of texts as 32-bit numbers.  Each raw run is folded once per cache, which is bounded."""

    def __init__(self, most: int = 300_000):
        self.of: dict[str, int] = {}
        self.many: list[list[int]] = []
        self.most = most

    def _learn(self, raws: set[str]) -> None:
        if len(self.of) > self.most:
            self.of.clear()
            self.many.clear()
        for raw in raws:
            numbers = [zlib.crc32(w.encode()) ^ (len(w) * 0x9E3779B1 & 0xFFFFFFFF) for w in words(raw)]
            if len(numbers) == 1:
                self.of[raw] = numbers[0]
            else:
                self.many.append(numbers)
                self.of[raw] = -len(self.many)

    def numbers(self, text: str) -> np.ndarray:
        raws = RAW.findall(text)
        try:
            out = np.fromiter(map(self.of.__getitem__, raws), np.int64, len(raws))
        except KeyError:
            self._learn(set(raws).difference(self.of))
            if any(r not in self.of for r in raws):  # the cache has just been emptied
                self._learn(set(raws))
            out = np.fromiter(map(self.of.__getitem__, raws), np.int64, len(raws))
        if len(out) and out.min() < 0:
            flat: list[int] = []
            for n in out.tolist():
                flat += [n] if n >= 0 else self.many[-n - 1]
            out = np.array(flat, np.int64)
        return out.astype(np.uint32)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the published constants of splitmix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(numbers: np.ndarray) -> np.ndarray:
    """A 64-bit number for each run of RUN words, in order."""
    if len(numbers) < RUN:
        return np.zeros(0, np.uint64)
    n = numbers.astype(np.uint64)
    a, b, c = n[:-2], n[1:-1], n[2:]
    return mix(mix((a << np.uint64(32)) | b) ^ (c * np.uint64(0x9E3779B97F4A7C15)))


def digest(distinct: np.ndarray) -> int:
    """One signed 64-bit number for a set of runs (sorted, distinct), by which equal sets are known."""
    return int.from_bytes(hashlib.blake2b(distinct.tobytes(), digest_size=8).digest(), "little", signed=True)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common runs of two sorted arrays of distinct runs; 0 where one is empty."""
    if not len(a) or not len(b):
        return 0.0
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(a) + len(b) - common)
