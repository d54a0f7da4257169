"""Byte-level BPE as whole-array work.

Texts are cut into chunks, distinct chunks into pre-tokens, and only pre-tokens that this worker has
not met before are encoded: they are bucketed by byte length into padded matrices, and in each round
every row merges its leftmost pair of minimum rank.  Pairs are looked up in an open-addressed hash
table; finished rows leave the matrix and its width shrinks with the longest row left.
"""

from __future__ import annotations

import json
import re

import numpy as np
import regex

#: The pre-tokeniser's published pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Unicode White_Space as a character class (fixed value).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Cuts where every pre-token ends too: an optional blank with what follows it, the blanks before the last one of a run, a single blank.
CHUNK = f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]"

INF = np.int32(2**31 - 1)
#: Rows longer than this are merged one by one, all occurrences of the best pair in each round.
LONG = 128
#: Entries of the worker's caches before they are emptied; bounds memory, never results.
CACHE = 300_000


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte, by its rule: printable Latin-1 stands for itself, the rest follows from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class PairTable:
    """(left, right) -> (rank, merged id), open addressing with linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray, bits: int = 19):
        self.bits = bits
        key = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        size = 1 << bits
        self.keys = np.full(size + 64, np.uint64(2**64 - 1))
        self.rank = np.full(size + 64, INF, np.int32)
        self.merged = np.zeros(size + 64, np.int32)
        self.probes = 1
        todo, at = np.arange(len(key)), self._slot(key)
        while len(todo):
            free = self.keys[at] == np.uint64(2**64 - 1)
            first = np.zeros(len(todo), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.keys[at[put]] = key[todo[put]]
            self.rank[at[put]] = rank[todo[put]]
            self.merged[at[put]] = merged[todo[put]]
            todo, at = todo[~put], at[~put]
            at = np.where(self.keys[at] != np.uint64(2**64 - 1), at + 1, at)
            self.probes += 1
        self.probes = 1
        home = self._slot(key)
        while True:
            seen = np.zeros(len(key), bool)
            for p in range(self.probes):
                seen |= self.keys[home + p] == key
            if seen.all():
                break
            self.probes += 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair, or of an empty entry (rank INF).  Negative ids are padding."""
        key = (left.astype(np.int64).astype(np.uint64) << np.uint64(32)) | right.astype(np.int64).astype(np.uint64)
        at = self._slot(key)
        slot = np.full(at.shape, len(self.keys) - 1, np.int64)
        for p in range(self.probes):
            hit = self.keys[at + p] == key
            slot = np.where(hit, at + p, slot)
        slot[(left < 0) | (right < 0)] = len(self.keys) - 1
        return slot


class ByteBPE:
    """Encoder of a tokenizer file of kind byte-level BPE."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        vocab, letters = model["vocab"], byte_letters()
        self.byte_id = np.zeros(256, np.int32)
        for letter, byte in letters.items():
            self.byte_id[byte] = vocab[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.pairs = PairTable(
            np.array([vocab[a] for a, _ in pairs], np.int64),
            np.array([vocab[b] for _, b in pairs], np.int64),
            np.arange(len(pairs), dtype=np.int32),
            np.array([vocab[a + b] for a, b in pairs], np.int32),
        )
        self.pre = regex.compile(PATTERN)
        self.chunk = re.compile(CHUNK)
        self._forget()

    def _forget(self) -> None:
        self.word: dict[str, np.ndarray] = {}
        self.known: dict[str, int] = {}
        self.parts: list[np.ndarray] = []
        self.lens = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    # -- pre-tokens -------------------------------------------------------------------------------

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        """One long row: every occurrence, from the left and without overlap, of its best pair per round.
        A pair made by a merge always ranks after that merge, so this is the same order as one by one."""
        while len(ids) > 1:
            slot = self.pairs.find(ids[:-1], ids[1:])
            rank = self.pairs.rank[slot]
            best = rank.min()
            if best == INF:
                break
            at = np.flatnonzero(rank == best)
            if len(at) > 1:  # in a run of neighbouring places every second one
                run = np.concatenate([[0], np.cumsum(np.diff(at) != 1)])
                first = at[np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1])]
                at = at[(at - first[run]) % 2 == 0]
            ids[at] = self.pairs.merged[slot[at[0]]]
            ids = np.delete(ids, at + 1)
        return ids

    def _merge_rows(self, rows: np.ndarray, out: list, where: np.ndarray) -> None:
        """Rows padded with -1; puts the ids of row k into out[where[k]]."""
        slot = self.pairs.find(rows[:, :-1], rows[:, 1:])
        rank, to = self.pairs.rank[slot], self.pairs.merged[slot]
        while len(rows):
            best = rank.argmin(1) if rank.shape[1] else np.zeros(len(rows), np.int64)
            each = np.arange(len(rows))
            live = rank[each, best] < INF if rank.shape[1] else np.zeros(len(rows), bool)
            if not live.all():
                for k in np.flatnonzero(~live):
                    row = rows[k]
                    out[where[k]] = row[row >= 0].copy()
                rows, rank, to, where, best = rows[live], rank[live], to[live], where[live], best[live]
                if not len(rows):
                    return
                width = int((rows >= 0).sum(1).max())
                rows, rank, to = rows[:, :width], rank[:, : width - 1], to[:, : width - 1]
                each = np.arange(len(rows))
            rows[each, best] = to[each, best]
            n = rows.shape[1]
            col = np.arange(n)[None, :]
            src = np.minimum(col + (col > best[:, None]), n - 1)
            rows = np.take_along_axis(rows, src, 1)
            rows[:, -1] = -1
            # pair k is (k, k+1): the pairs after the merged one move left by one
            m = n - 1
            pcol = np.arange(m)[None, :]
            psrc = np.minimum(pcol + (pcol >= best[:, None]), m - 1)
            rank, to = np.take_along_axis(rank, psrc, 1), np.take_along_axis(to, psrc, 1)
            rank[:, -1] = INF
            for shift in (-1, 0):
                at = best + shift
                ok = (at >= 0) & (at < m)
                r, a = each[ok], at[ok]
                s = self.pairs.find(rows[r, a], rows[r, a + 1])
                rank[r, a], to[r, a] = self.pairs.rank[s], self.pairs.merged[s]

    def _learn(self, words: list[str]) -> None:
        """Encode pre-tokens that aren't in the cache yet."""
        raw = [w.encode("utf-8") for w in words]
        size = np.array([len(b) for b in raw])
        out: list = [None] * len(raw)
        for k in np.flatnonzero(size > LONG):
            out[k] = self._merge_long(self.byte_id[np.frombuffer(raw[k], np.uint8)].copy())
        low = 0
        for high in (1, 4, 8, 12, 16, 24, 32, 48, 64, LONG):
            which = np.flatnonzero((size > low) & (size <= high))
            low = high
            for part in np.array_split(which, max(1, len(which) * high // 400_000)) if len(which) else ():
                rows = np.full((len(part), int(size[part].max())), -1, np.int32)
                joined = np.frombuffer(b"".join(raw[k] for k in part), np.uint8)
                n = size[part]
                row = np.repeat(np.arange(len(part)), n)
                col = np.arange(len(joined)) - np.repeat(np.cumsum(n) - n, n)
                rows[row, col] = self.byte_id[joined]
                self._merge_rows(rows, out, part)
        self.word.update(zip(words, out))

    # -- texts ------------------------------------------------------------------------------------

    def _index(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Number of chunks of each text, and the index of each chunk among the known ones."""
        if len(self.known) > CACHE:
            self._forget()
        found = [self.chunk.findall(t) if t else [] for t in texts]
        count = np.fromiter(map(len, found), np.int64, len(found))
        flat = [c for chunks in found for c in chunks]
        new = list(set(flat).difference(self.known))
        if new:
            pieces = [self.pre.findall(c) for c in new]
            fresh = list({w for ws in pieces for w in ws}.difference(self.word))
            if fresh:
                self._learn(fresh)
            word = self.word
            rows = [word[ws[0]] if len(ws) == 1 else np.concatenate([word[w] for w in ws]) for ws in pieces]
            base = len(self.known)
            self.known.update(zip(new, range(base, base + len(new))))
            lens = np.fromiter(map(len, rows), np.int64, len(rows))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lens) - lens])
            self.lens = np.concatenate([self.lens, lens])
            self.flat = np.concatenate([self.flat, *rows])
        return count, np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))

    def counts(self, texts: list) -> np.ndarray:
        """Number of tokens of each text; 0 for an empty text and for None."""
        count, index = self._index(texts)
        total = np.concatenate([[0], np.cumsum(self.lens[index])])
        ends = np.cumsum(count)
        return total[ends] - total[ends - count]

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of all texts; no ids for an empty text and for None."""
        count, index = self._index(texts)
        lens = self.lens[index]
        total = np.concatenate([[0], np.cumsum(lens)])
        ids = self.flat[np.repeat(self.starts[index] - total[:-1], lens) + np.arange(total[-1])]
        return np.concatenate([[0], total[np.cumsum(count)]]), ids


_ENCODERS: dict[str, ByteBPE] = {}


def encoder(path: str) -> ByteBPE:
    """The worker's encoder of this file; kept, with its caches, between batches and tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteBPE(path)
    return _ENCODERS[path]
