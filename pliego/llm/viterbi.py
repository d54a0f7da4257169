"""Counting the tokens of a piece vocabulary without building them.

A double-array trie holds the pieces; for every normalised segment all matches are found at once and
a count-only Viterbi pass keeps, per position, the best score and the length of its path.  Segments
are distinct per worker, so a word that stands a million times is counted once.

For a unigram vocabulary the path of the highest score wins.  A BPE vocabulary has no path scores:
there the path is the one whose neighbouring pieces are each what BPE makes of their joined text,
which is unique and equal to the BPE encoding; the same pass follows it, with that test in place of
the sum.
"""

from __future__ import annotations

import re

import numpy as np

from pliego.llm.byte_bpe import PairTable

BLANK = "▁"
#: How far below the lowest score an unknown character lies (the library's fixed value).
UNKNOWN = 10.0
#: Chunks longer than this are cut between characters that no piece holds side by side.
LONG = 24
CACHE = 400_000
NONE = np.int32(2**31 - 1)


class DoubleArray:
    """A trie over UTF-8 bytes in two arrays: child = base[node] + byte + 1, owned if check[child] == node."""

    def __init__(self, words: list[bytes]):
        order = sorted(range(len(words)), key=words.__getitem__)
        room = 1 << 18
        base, check, value, free = np.zeros(room, np.int32), np.full(room, -1, np.int32), np.full(room, -1, np.int32), np.ones(room, bool)
        check[0], free[0] = 0, False
        keys = [words[k] for k in order]
        work, cursor, window = [(0, 0, len(order), 0)], 1, 512
        while work:
            nxt = []
            for node, lo, hi, depth in work:
                while lo < hi and len(keys[lo]) == depth:
                    value[node] = order[lo]
                    lo += 1
                if lo == hi:
                    continue
                groups, at = [], lo
                while at < hi:
                    byte, end = keys[at][depth], at
                    while end < hi and keys[end][depth] == byte:
                        end += 1
                    groups.append((byte + 1, at, end))
                    at = end
                b = cursor
                while True:  # first fit, a window of places at once
                    if b + window + 300 > len(check):
                        base, check, value, free = (np.concatenate([a, np.full(len(a), f, a.dtype)]) for a, f in ((base, 0), (check, -1), (value, -1), (free, True)))
                    fits = free[b + groups[0][0] : b + groups[0][0] + window].copy()
                    for code, _, _ in groups[1:]:
                        fits &= free[b + code : b + code + window]
                    k = int(fits.argmax())
                    if fits[k]:
                        b += k
                        break
                    b += window
                if b - cursor > 2 * window:  # it's crowded there: go on from here
                    cursor = b - window
                base[node] = b
                for code, s, e in groups:
                    check[b + code], free[b + code] = node, False
                    nxt.append((b + code, s, e, depth + 1))
            work = nxt
        used = int(np.flatnonzero(~free).max()) + 300
        pad = lambda a, f: np.concatenate([a[:used], np.full(max(0, used - len(a)), f, np.int32)])
        self.base, self.check, self.value = pad(base, 0), pad(check, -1), pad(value, -1)

    def matches(self, rows: np.ndarray, size: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, start, end, word) of every word that stands at one of the marked starts of the padded rows."""
        row, start = np.nonzero(starts)
        node, found = np.zeros(len(row), np.int32), []
        at = start.copy()
        while len(row):
            live = at < size[row]
            row, start, at, node = row[live], start[live], at[live], node[live]
            if not len(row):
                break
            child = self.base[node] + rows[row, at].astype(np.int32) + 1
            live = (self.check[child] == node) & (self.base[node] > 0)
            row, start, at, node = row[live], start[live], at[live] + 1, child[live]
            hit = self.value[node] >= 0
            found.append((row[hit], start[hit], at[hit], self.value[node[hit]]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 4


def greedy_merges(parts: list[int], rank, merged) -> tuple[list[int], tuple[int, int] | None]:
    """Plain BPE on one short sequence: the pair of best rank, the leftmost first.  Also the last pair merged."""
    parts, last = list(parts), None
    while len(parts) > 1:
        best = min(((r, k) for k in range(len(parts) - 1) if (r := rank(parts[k], parts[k + 1])) is not None), default=None)
        if best is None:
            break
        k = best[1]
        last = (parts[k], parts[k + 1])
        parts[k : k + 2] = [merged(*last)]
    return parts, last


class PieceCounter:
    """Counts the pieces of texts.  `pieces`: (text, score) without the control and byte pieces.

    bpe: whether scores order merges (BPE) or add up along a path (unigram).
    byte_fallback: an unknown character counts one piece per byte, otherwise one.
    """

    def __init__(self, pieces: list[tuple[str, float]], bpe: bool, byte_fallback: bool = True, dummy_prefix: bool = True):
        self.bpe, self.byte_fallback, self.dummy_prefix = bpe, byte_fallback, dummy_prefix
        if bpe:
            pieces = sorted(pieces, key=lambda p: (len(p[0]) > 1, -p[1] if len(p[0]) > 1 else p[0]))
            pieces = self._learn_merges(pieces)
        self.pieces = [p for p, _ in pieces]
        self.score = np.array([s for _, s in pieces], np.float64)
        self.low = (self.score.min() if len(pieces) else 0.0) - UNKNOWN
        self.trie = DoubleArray([p.encode() for p in self.pieces])
        self.joined = {a + b for p in self.pieces for a, b in zip(p, p[1:])}
        cut = "" if any("\n" in pair for pair in self.joined) else "\n"
        self.chunk = re.compile(f" *[^ {cut}]+| +" + (f"|{cut}+" if cut else ""))
        self.cache: dict[str, int] = {}

    def _learn_merges(self, pieces: list[tuple[str, float]]) -> list[tuple[str, float]]:
        """Pieces in order of merging, without those that merging never makes; the last merge of each; the table of pairs."""
        index = {p: k for k, (p, _) in enumerate(pieces)}
        score = [s for _, s in pieces]

        def rank(a: int, b: int):
            k = index.get(pieces[a][0] + pieces[b][0])
            return None if k is None else -score[k]

        merged = lambda a, b: index[pieces[a][0] + pieces[b][0]]
        self._rank, self._merged, self._index = rank, merged, index
        parent = np.full((len(pieces), 2), -1, np.int64)
        for k, (p, _) in enumerate(pieces):
            if len(p) > 1 and all(c in index for c in p):
                out, last = greedy_merges([index[c] for c in p], rank, merged)
                if out == [k]:
                    parent[k] = last
        made = [k for k, (p, _) in enumerate(pieces) if len(p) == 1 or parent[k, 0] >= 0]
        left, right, to = [], [], []
        for k in made:
            p = pieces[k][0]
            for c in range(1, len(p)):
                a, b = index.get(p[:c]), index.get(p[c:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), to.append(k)
        new = {k: n for n, k in enumerate(made)}
        keep = [n for n in range(len(to)) if left[n] in new and right[n] in new]
        arr = lambda x: np.array([new[x[n]] for n in keep], np.int64)
        merge_to = arr(to).astype(np.int32)
        self.table = PairTable(arr(left), arr(right), merge_to, merge_to)
        self.split = np.array([[new.get(a, -1), new.get(b, -1)] for a, b in parent[made]], np.int64).reshape(-1, 2)
        out = [pieces[k] for k in made]
        index = {p: k for k, (p, _) in enumerate(out)}
        score = [s for _, s in out]
        self._text = [p for p, _ in out]
        self._index, self._score = index, score
        return out

    def _compatible(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether BPE leaves the texts of pieces `one` and `two`, joined, as these two pieces: undo merges in turn, newest first; a merge across the seam that would have come before is a contradiction."""
        ok = np.ones(len(one), bool)
        todo = np.flatnonzero((one >= 0) & (two >= 0))  # an unknown character joins nothing
        a, b = one[todo].copy(), two[todo].copy()
        limit = np.full(len(todo), NONE, np.int64)
        while len(todo):
            bad = self.table.rank[self.table.find(a, b)] < limit
            ok[todo[bad]] = False
            go = ~bad
            todo, a, b, limit = todo[go], a[go], b[go], limit[go]
            newer = a > b
            done = np.zeros(len(todo), bool)
            # undo the newer of the two; once its parts are used up, the other one
            for first, second in ((True, False), (False, True)):
                at = np.flatnonzero(newer if first else ~newer)
                if not len(at):
                    continue
                x = a if first else b
                y = b if first else a
                side_x, side_y = (1, 0) if first else (0, 1)
                lim = x[at] + (0 if first else 1)
                leaf = self.split[x[at], 0] < 0
                limit[at] = lim
                x[at[~leaf]] = self.split[x[at[~leaf]], side_x]
                rest = at[leaf]
                if len(rest):
                    leaf_y = self.split[y[rest], 0] < 0
                    limit[rest] = y[rest] + (1 if first else 0)
                    y[rest[~leaf_y]] = self.split[y[rest[~leaf_y]], side_y]
                    done[rest[leaf_y]] = True
            todo, a, b, limit = todo[~done], a[~done], b[~done], limit[~done]
        return ok

    def _paths(self, segments: list[str]) -> np.ndarray:
        raw = [s.encode() for s in segments]
        size = np.array([len(r) for r in raw], np.int64)
        width = int(size.max())
        rows = np.zeros((len(raw), width), np.uint8)
        joined = np.frombuffer(b"".join(raw), np.uint8)
        r = np.repeat(np.arange(len(raw)), size)
        c = np.arange(len(joined)) - np.repeat(np.cumsum(size) - size, size)
        rows[r, c] = joined
        inside = np.arange(width)[None, :] < size[:, None]
        starts = inside & ((rows & 0xC0) != 0x80)
        lead = rows[starts]
        nbytes = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        row, start, end, word = self.trie.matches(rows, size, starts)
        # characters that are no piece of their own
        srow, sstart = np.nonzero(starts)
        alone = np.zeros((len(raw), width), bool)
        length = np.zeros((len(raw), width), np.int64)
        length[srow, sstart] = nbytes
        single = length[row, start] == end - start
        alone[row[single], start[single]] = True
        miss = ~alone[srow, sstart]
        weight = np.ones(len(row), np.int64)
        row, start, end = (np.concatenate([x, y]) for x, y in ((row, srow[miss]), (start, sstart[miss]), (end, sstart[miss] + nbytes[miss])))
        word = np.concatenate([word.astype(np.int64), np.full(miss.sum(), -1, np.int64)])
        weight = np.concatenate([weight, nbytes[miss] if self.byte_fallback else np.ones(miss.sum(), np.int64)])
        order = np.argsort(start, kind="stable")
        row, start, end, word, weight = (x[order] for x in (row, start, end, word, weight))
        bounds = np.searchsorted(start, np.arange(width + 1))
        count = np.full((len(raw), width + 1), -1, np.int64)
        count[:, 0] = 0
        last = np.full((len(raw), width + 1), -1, np.int64)
        best = np.full((len(raw), width + 1), -np.inf)
        best[:, 0] = 0
        gain = np.where(word >= 0, self.score[word], self.low) if len(self.score) else np.full(len(word), self.low)
        for i in range(width):
            s = slice(bounds[i], bounds[i + 1])
            if s.start == s.stop:
                continue
            w, e, k = row[s], end[s], word[s]
            ok = count[w, i] >= 0
            if self.bpe:
                ok &= self._compatible(last[w, i], k)
            else:
                total = best[w, i] + gain[s]
                ok &= total > best[w, e]
                best[w[ok], e[ok]] = total[ok]
            w, e = w[ok], e[ok]
            count[w, e] = count[w, i] + weight[s][ok]
            last[w, e] = k[ok]
        return count[np.arange(len(raw)), size]

    def _runs(self, chunk: str) -> int:
        """A chunk with runs of blanks, whose pieces all rank alike: merged one by one, the leftmost first."""
        parts, n = [], 0
        for c in chunk:
            if c in self._index:
                parts.append(self._index[c])
            else:
                n += (len(greedy_merges(parts, self._pair, self._to)[0]) if parts else 0) + (len(c.encode()) if self.byte_fallback else 1)
                parts = []
        return n + (len(greedy_merges(parts, self._pair, self._to)[0]) if parts else 0)

    def _pair(self, a: int, b: int):
        k = self._index.get(self._text[a] + self._text[b])
        return None if k is None else -self._score[k]

    def _to(self, a: int, b: int) -> int:
        return self._index[self._text[a] + self._text[b]]

    def _learn(self, chunks: list[str]) -> None:
        cut: list[list[str]] = []
        joined = self.joined
        for chunk in chunks:
            text = chunk.replace(" ", BLANK)
            if self.bpe and BLANK * 2 in text:
                at = len(text) - len(text.lstrip(BLANK))
                head, tail = text[: at + LONG], text[at + LONG :]
                if not tail:
                    self.cache[chunk] = self._runs(text)
                    cut.append([])
                    continue
            if len(text) <= LONG:
                cut.append([text])
                continue
            parts, at = [], 0
            for k in range(1, len(text)):
                if text[k - 1 : k + 1] not in joined:
                    parts.append(text[at:k])
                    at = k
            cut.append([*parts, text[at:]])
        fresh = list({s for parts in cut for s in parts})
        if fresh:
            size = np.array([len(s.encode()) for s in fresh])
            number = np.zeros(len(fresh), np.int64)
            low = 0
            for high in (2, 4, 8, 12, 16, 24, 32, 48, 64, 128, 256, 1024, 1 << 62):
                which = np.flatnonzero((size > low) & (size <= high))
                low = high
                if len(which):
                    for part in np.array_split(which, max(1, int(size[which].sum()) // 200_000)):
                        number[part] = self._paths([fresh[k] for k in part])
            of = dict(zip(fresh, number.tolist()))
            self.cache.update((chunk, sum(of[s] for s in parts)) for chunk, parts in zip(chunks, cut) if parts)

    def counts(self, texts: list) -> np.ndarray:
        """Number of pieces of each text; 0 for an empty text and for None."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        prefix = " " if self.dummy_prefix else ""
        found = [self.chunk.findall(prefix + t.replace(BLANK, " ")) if t else [] for t in texts]
        new = list({c for chunks in found for c in chunks}.difference(self.cache))
        if new:
            self._learn(new)
        get = self.cache.__getitem__
        return np.array([sum(map(get, chunks)) for chunks in found], np.int64)


def from_sentencepiece(path: str) -> PieceCounter:
    """The counter of a sentencepiece model file, unigram or BPE."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces = [(sp.id_to_piece(k), sp.get_score(k)) for k in range(n) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k) or sp.is_unused(k))]
    probe = "".join(p.replace(BLANK, " ") for p, _ in pieces[200:260])
    bpe = all(float(s).is_integer() for _, s in pieces) and bool(probe)
    return PieceCounter(pieces, bpe=bpe, byte_fallback=any(sp.is_byte(k) for k in range(n)))


_COUNTERS: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    """The worker's counter of this file, kept with its cache between tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = from_sentencepiece(path)
    return _COUNTERS[path]
