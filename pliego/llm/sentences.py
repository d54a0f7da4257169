"""Problem 8: sentence boundaries by a hidden-event language model.

Between the words of a block lie gaps; a hidden event, boundary or none, stands in each gap where a
sentence might end.  The model is a bigram over words and events.  What it needs to know, how often a
word stands before a boundary and how often after one, shows at the edges of blocks: each ends with a
boundary and begins after one, and inside blocks there are so many boundaries per edge as there are
questions and exclamations inside per one at an end.  So words are counted at edges and at gaps over the
whole corpus, each by itself, and an abbreviation is a word that stops often and ends nothing.
A second count leaves out the gaps that the first has settled (before a word that opens nothing, after one
that closes nothing).  A forward-backward pass over the gaps of a block then gives the posterior of each
event, in which neighbouring events depend on one another through the length of what lies between them.

Texts are scanned once, into a table of gaps; counting and decoding are array work on that.  Words are known by 64
bits, and each has counts of its own.  They go to all workers, unless there are more than KEPT words on a side; then
those of words that stand there in more than one in KEPT of all gaps do, which are KEPT at most, and each text's gaps
are lent the others by a join.  The results are the same.

What stands in quotes or brackets can't end the sentence that holds them; Thai has no marks, there the
blanks are the gaps and the event is read off the characters beside them.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pliego.llm.spark import columns, drop, lent, prepare, stored

#: Words on either side of gaps whose counts go to all workers at most; word classes.
KEPT, CLASSES = 1 << 20, 64
#: Weight of a word's class in gaps, and the posterior below which one side settles a gap.
PRIOR, SETTLED = 2.0, 0.05
#: The share of a word's gaps that the second count must have kept to be of use.
LEFT = 0.03
#: Bounds of a word's share of boundaries: one that never stands at an edge says much, one that often does
#: says less, as its boundaries inside blocks are only reckoned from those at edges.
LEAST, MOST = 1e-4, 0.96
#: Fields of a record: kind, two places, flags, and of the words before and after their classes (-1 for no word) and two halves of their numbers.
FIELDS = 10
KIND, FROM, TO, FLAGS, CLASS, WORD = 0, 1, 2, 3, (4, 5), (6, 8)
FULL, CLOSE, FORCED, SINGLE = 1, 2, 4, 8

# -- fixed values: marks, quotes and brackets -------------------------------------------------------
FULL_MARKS = "!?！？。｡؟।॥‼⁇⁈⁉։።۔;"
MARK = ".．!?！？。｡؟।॥…‼⁇⁈⁉։።۔;"
STOP = ".．…"
MARKS = frozenset(MARK)
NOT_AFTER = MARK + ",:;，、：；"
INNER = " \u00a0\u202f\n»”’)]」』"
PAIRS = {"«": "»", "“": "”", "„": "“", "(": ")", "[": "]", "{": "}", "「": "」", "『": "』", "《": "》", "〈": "〉", "（": "）", "【": "】", "‹": "›"}
CLOSERS = set(PAIRS.values())
BREAK = "\r\n|[\n\r\x0b\x0c\x85\u2028\u2029]"

_LINE = re.compile(BREAK)
_THAI = re.compile("[\u0e01-\u0e5b]")
_THAI_GAP = re.compile("(?<![\\s0-9\u0e50-\u0e59])[^\\S\n\r]+(?![\\s0-9\u0e50-\u0e59])")
_EVENT = re.compile("[%s]+|[%s%s\"]" % (re.escape(MARK), re.escape("".join(PAIRS)), re.escape("".join(CLOSERS))))
_NEXT = re.compile(r"[\s«“„(\[{「『《〈（【‹\"'¿¡]*([^\W_]+|.)?", re.DOTALL)
_MARKER = re.compile(r"\s*(?:[0-9]{1,3}|[A-Za-z]{1,2}|[ivxIVX]{1,5})(?:\.[0-9]{1,3})*$")
_DIGITS = re.compile(r"[0-9]+")
_GREEK = re.compile("[\u0370-\u03ff]")
_BEFORE = re.compile(r"[^\s«“„(\[{¿¡'\"<]+$")
_IDEOGRAM = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")


def blocks(text: str) -> list[tuple[int, int]]:
    """[from, to) of each block: parted by empty lines if there are any, else each line is one."""
    out, start, at, lines = [], None, 0, []
    for m in _LINE.finditer(text):
        lines.append((at, m.start()))
        at = m.end()
    lines.append((at, len(text)))
    blank = [not text[a:b] or text[a:b].isspace() for a, b in lines]
    if not any(blank):
        return lines
    if all(blank):
        return []
    inner = blank[blank.index(False) : len(blank) - blank[::-1].index(False)]
    if True not in inner:
        return [line for line, empty in zip(lines, blank) if not empty]
    end = 0
    for (a, b), empty in zip(lines, blank):
        if empty:
            if start is not None:
                out.append((start, end))
                start = None
        else:
            start, end = a if start is None else start, b
    if start is not None:
        out.append((start, end))
    return out


def _word(run: str) -> str:
    """The key of a word: lower case, digits as one class, of a text without blanks its first two characters."""
    if run.isdigit():
        return "9"
    if _IDEOGRAM.match(run):
        return run[:2]
    return _DIGITS.sub("9", run.lower()) if not run.isalpha() else run.lower()


def _one_word(piece: str) -> bool:
    """Whether a piece is a single word; scripts without blanks don't say."""
    return len(piece.split()) < 2 and not _IDEOGRAM.search(piece)


def _spans(events: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The outermost matched quotes and brackets as (opens at, closes at)."""
    stack: list[tuple[str, int]] = []
    found = []
    straight = sum(1 for e in events if e[0] == '"')
    for c, at, _ in events:
        if c == '"':
            if any(o == '"' for o, _ in stack):
                while stack[-1][0] != '"':
                    stack.pop()
                found.append((stack.pop()[1], at))
            elif straight > 1:
                stack.append((c, at))
            straight -= 1
        elif c in CLOSERS and stack and any(PAIRS.get(o) == c for o, _ in stack) and not (c == "“" and stack[-1][0] != "„"):
            while PAIRS.get(stack[-1][0]) != c:
                stack.pop()
            found.append((stack.pop()[1], at))
        elif c in PAIRS:
            stack.append((c, at))
    found.sort()
    outer: list[tuple[int, int]] = []
    for a, b in found:
        if not outer or a > outer[-1][1]:
            outer.append((a, b))
    return outer


def kind(word: str) -> int:
    """The class of a word: what it is made of, its case, its length."""
    c = word[0]
    if c.isdigit():
        return 1 if len(word) == 1 else 2
    if not c.isalpha():
        return 3 if c in FULL_MARKS else 4
    if "." in word[:-1]:
        return 5
    return 8 + min(len(word.rstrip("^")), 9) + (10 if word[-1] == "^" else 0) + (20 if c > "\u2fff" else 0)


NONE = (-1, 0, 0)


def record(kind: int, start: int, end: int, flags: int, before: tuple[int, int, int], after: tuple[int, int, int]) -> list[int]:
    return [kind, start, end, flags, before[0], after[0], *before[1:], *after[1:]]


class Scanner:
    """Texts into records; remembers words."""

    def __init__(self):
        self.known: dict[str, tuple[int, int, int]] = {}

    def of(self, key: str) -> tuple[int, int, int]:
        """The class and the two halves of the number of a word."""
        found = self.known.get(key)
        if found is None:
            if len(self.known) > 300_000:
                self.known.clear()
            n = xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass"))
            found = self.known[key] = (kind(key), *((h ^ 1 << 31) - (1 << 31) for h in (n & 0xFFFFFFFF, n >> 32)))
        return found

    def after(self, run: str | None) -> tuple[int, int, int]:
        """The key of the word after a gap: with its case."""
        if not run:
            return self.of("-")
        w = _word(run)
        return self.of(w + "^" if run[0].isupper() else w)

    def scan(self, text: str) -> list[int]:
        out: list[int] = []
        thai = _THAI.search(text) is not None
        greek = _GREEK.search(text) is not None
        for a, b in blocks(text):
            block = text[a:b]
            size = len(block.rstrip())
            lead = len(block) - len(block.lstrip())
            if thai and _THAI.search(block):
                out += record(0, a + lead, a + size, 0, NONE, NONE)
                for m in _THAI_GAP.finditer(block, lead, size):
                    out += record(1, a + m.start(), a + m.end(), FORCED, NONE, NONE)
                continue
            inner: list[int] = []
            final = self.gaps(block, size, a, greek, inner)
            single = SINGLE if final is not None and not inner and _one_word(block) else 0
            out += record(0, a + lead, a + size, single, NONE if final is None else self.of(final), self.after(_NEXT.match(block)[1]))
            out += inner
        return out

    def gaps(self, block: str, size: int, base: int, greek: bool, out: list[int]) -> str | None:
        """Appends the gaps of a block where a sentence may end; the key before the block's own end, if it ends with a mark."""
        events = [(m[0], m.start(), m.end()) for m in _EVENT.finditer(block)]
        outer = _spans([e for e in events if e[0][0] not in MARKS]) if any(e[0][0] not in MARKS for e in events) else ()
        final, k, last = None, 0, 0
        for mark, start, end in events:
            if mark[0] not in MARKS:
                continue
            if ";" in mark and not (greek and mark.strip(".") == ";"):
                if not (mark := mark.split(";")[0]):
                    continue
                end = start + len(mark)
            while k < len(outer) and outer[k][1] < start:
                k += 1
            closed = ""
            if k < len(outer) and outer[k][0] < start:
                o, c = outer[k]
                if c - end > 8 or block[end:c].strip(INNER):
                    continue
                before = block[:o].rstrip()[-1:]
                closed = block[c] + (":" if before in ":：" and before else "" if not before or before in MARKS or before in CLOSERS else "w")
                end = c + 1
            stop = mark[0] in STOP
            if end < size:
                after = block[end]
                if after in NOT_AFTER or (stop and after.isdigit() and not closed) or (after in "%)" and not closed):
                    continue
            if not stop:
                key = mark[-1]
            elif len(mark) > 1 or mark == "…":
                key = "…"
            else:
                piece = _BEFORE.search(block, max(0, start - 40), start)
                key = _word(piece[0].rpartition("/")[2] or piece[0]) if piece else "-"
            key += closed
            if end >= size:
                final = key
                continue
            if stop and not closed and start < 12 and _MARKER.match(block[:start]):
                continue
            m = _NEXT.match(block, end)
            flags = (0 if stop or closed else FULL) | (CLOSE if last and _one_word(block[last:end]) else 0)
            begin = end
            while block[begin].isspace():
                begin += 1
            out += record(1, base + end, base + begin, flags, self.of(key), self.after(m[1]))
            last = end
        return final


def records(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The records of several texts, and the text of each."""
    size = np.array([len(p) // (4 * FIELDS) for p in packed], np.int64)
    return np.frombuffer(b"".join(packed), np.int32).reshape(-1, FIELDS), np.repeat(np.arange(len(packed)), size)


def numbers(rec: np.ndarray, side: int) -> np.ndarray:
    """The words' numbers on one side."""
    return np.ascontiguousarray(rec[:, WORD[side] : WORD[side] + 2]).view(np.int64)[:, 0]


#: Rows of a count: words before and after gaps, their classes, and what is counted once; how often in gaps, and at edges.
COUNTS = ["what", "key", "gaps", "edges"]
BY_WORD, BY_CLASS, REST = (0, 1), (2, 3), 4
FULLS, FULL_ENDS, SINGLES, EDGES, GAPS = range(5)


def tally(rec: np.ndarray, keep=None) -> pd.DataFrame:
    """Counts of records; `keep` says of gaps which to count on a side."""
    gap = rec[(rec[:, KIND] == 1) & (rec[:, FLAGS] & FORCED == 0)]
    edge = rec[(rec[:, KIND] == 0) & (rec[:, CLASS[0]] >= 0)]
    parts = []
    for side in (0, 1):
        some = gap if keep is None else gap[keep(gap, side)]
        for what, of in ((BY_WORD[side], lambda r: numbers(r, side)), (BY_CLASS[side], lambda r: r[:, CLASS[side]])):
            parts += [(what, of(some), 1, 0), (what, of(edge), 0, 1)]
    rest = [(gap[:, FLAGS] & FULL > 0).sum(), (edge[:, CLASS[0]] == 3).sum(), (edge[:, FLAGS] & SINGLE > 0).sum(), len(edge), len(gap)]
    frames = [pd.DataFrame({"what": what, "key": key.astype(np.int64), "gaps": g, "edges": e}) for what, key, g, e in parts]
    return added([*frames, pd.DataFrame({"what": REST, "key": range(len(rest)), "gaps": rest, "edges": 0})])


def added(frames: list[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(frames).groupby(["what", "key"], as_index=False, sort=False)[["gaps", "edges"]].sum()


def by_word(counts: pd.DataFrame) -> list[tuple[np.ndarray, ...]]:
    """On either side the words, sorted, and how often they stand in gaps and at edges."""
    what = counts["what"].to_numpy()
    return [tuple(one[c].to_numpy() for c in COUNTS[1:]) for side in (0, 1) for one in [counts[what == BY_WORD[side]].sort_values("key")]]


def of_batch(rows: pa.ListArray) -> pd.DataFrame:
    """The counts lent to a batch, each once."""
    of = rows.flatten()
    return pd.DataFrame({f.name: of.field(k).to_numpy(zero_copy_only=False) for k, f in enumerate(of.type)}).drop_duplicates(COUNTS[:2])


class Tables:
    """Counts before and after gaps and edges, by word and by class, looked up by arrays; and those lent to the gaps at hand."""

    def __init__(self, counts: pd.DataFrame):
        what = counts["what"].to_numpy()
        self.words, self.shares = by_word(counts), []
        self.lent = by_word(counts[:0])
        self.rest = np.zeros(5)
        some = counts[what == REST]
        self.rest[some["key"]] = some["gaps"]
        self.ratio = (self.rest[FULLS] + 1) / (self.rest[FULL_ENDS] + 1)
        for side in (0, 1):
            per, seen, edge = counts[what == BY_CLASS[side]], np.zeros(CLASSES), np.zeros(CLASSES)
            seen[per["key"]], edge[per["key"]] = per["gaps"], per["edges"]
            self.shares.append(np.clip((np.minimum(self.ratio * edge, seen) + 0.5) / (seen + 1), 0.02, 0.98))

    def lend(self, counts: pd.DataFrame) -> None:
        """Takes the counts of the other words of a batch, in place of the batch's before."""
        self.lent = by_word(counts)

    def own(self, word: np.ndarray, side: int) -> np.ndarray:
        """Whether words have counts here on a side, but for those lent."""
        return np.isin(word, self.words[side][0])

    def seen(self, rec: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """How often the words on one side stand in gaps and at edges; 0 for words that never stood in one."""
        word, in_gaps, at_edges = numbers(rec, side), np.zeros(len(rec)), np.zeros(len(rec))
        for keys, gaps, edges in (self.words[side], self.lent[side]):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, word), len(keys) - 1)
                here = keys[at] == word
                in_gaps, at_edges = np.where(here, gaps[at], in_gaps), np.where(here, edges[at], at_edges)
        return in_gaps, at_edges

    def odds(self, rec: np.ndarray, side: int) -> np.ndarray:
        """Log odds of a boundary by the share of boundaries among the gaps of the word on one side."""
        gaps, edges = self.seen(rec, side)
        p = (np.minimum(self.ratio * edges, gaps) + PRIOR * self.shares[side][rec[:, CLASS[side]]]) / (gaps + PRIOR)
        p = np.clip(p, LEAST, MOST)
        return np.log(p / (1 - p))


class Model:
    """Posteriors of the gaps from the two counts."""

    def __init__(self, first: pd.DataFrame, second: pd.DataFrame):
        self.one, self.two = Tables(first), Tables(second)
        self.single = (self.one.rest[SINGLES] + 0.5) / (self.one.rest[EDGES] + 100.0)

    def lend(self, counts: pd.DataFrame) -> None:
        """Takes both counts of the other words of a batch."""
        self.one.lend(counts)
        self.two.lend(counts[COUNTS[:2]].assign(gaps=counts["gaps2"], edges=counts["edges2"]))

    def odds(self, gap: np.ndarray) -> np.ndarray:
        """Log odds of a boundary: by the second count, where the word stands at edges at all and not nearly all its gaps were settled."""
        total = np.zeros(len(gap))
        for side in (0, 1):
            gaps, edges = self.one.seen(gap, side)
            left = self.two.seen(gap, side)[0] / np.maximum(gaps, 1)
            o = np.where((edges > 0) & (left >= LEFT), self.two.odds(gap, side), self.one.odds(gap, side))
            total += np.where((side == 0) & (gap[:, FLAGS] & FULL > 0), np.maximum(o, 4.6), o)
        return np.where(gap[:, FLAGS] & FORCED > 0, 50.0, np.clip(total, -30, 30))

    def boundaries(self, rec: np.ndarray) -> np.ndarray:
        """Of each record, whether a boundary stands there (blocks: no), by forward-backward over each block's gaps."""
        is_gap = rec[:, KIND] == 1
        block = np.cumsum(~is_gap)[is_gap]
        gap = rec[is_gap]
        if not len(gap):
            return np.zeros(len(rec), bool)
        emit = np.exp(self.odds(gap))
        close = np.where(gap[:, FLAGS] & CLOSE > 0, self.single, 1.0)
        first = np.concatenate([[True], block[1:] != block[:-1]])
        close[first] = 1.0
        start = np.flatnonzero(first)
        count = np.diff(np.concatenate([start, [len(gap)]]))
        fb = np.zeros(len(gap))
        order = np.argsort(-count, kind="stable")
        start, count = start[order], count[order]
        longest = int(count[0])
        live = [int(np.searchsorted(-count, -t, side="left")) for t in range(longest)]  # blocks with more than t gaps
        prev = np.ones(len(start))
        for t in range(longest):
            at = start[: live[t]] + t
            p = prev[: live[t]] if t else np.ones(live[t])
            yes = emit[at] * (p * close[at] + (1 - p))
            fb[at] = yes / (yes + 1)
            prev = fb[at]
        post = fb.copy()
        later_b, later_n = np.ones(len(start)), np.ones(len(start))
        for t in range(longest - 1, -1, -1):
            at = start[: live[t]] + t
            lb, ln = later_b[: live[t]], later_n[: live[t]]
            x, y = fb[at] * lb, (1 - fb[at]) * ln
            post[at] = x / (x + y)
            nb, nn = emit[at] * close[at] * lb + ln, emit[at] * lb + ln
            later_b[: live[t]], later_n[: live[t]] = nb / (nb + nn), nn / (nb + nn)
        out = np.zeros(len(rec), bool)
        out[is_gap] = post >= 0.5
        return out


def units(rec: np.ndarray, text: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, from, to) of the sentence units."""
    is_block = rec[:, KIND] == 0
    begins = is_block | cut
    start = np.where(is_block, rec[:, FROM], rec[:, TO])[begins]
    of = np.cumsum(is_block) - 1
    block_end = rec[is_block, TO]
    which = np.flatnonzero(begins)
    follows = np.concatenate([which[1:], [len(rec)]])
    last = follows >= len(rec)
    nxt = np.where(last, 0, follows)
    end = np.where(last | is_block[nxt], block_end[of[which]], rec[nxt, FROM])
    return text[which], start, end


def sentences(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key, inicio, fin` of every sentence unit of every row of df, in code points.

    Blank and null texts have none; repeated rows come out as often as they stand there; a text of any
    length is one value, cut block by block.  The counts are over all rows and of all words; what is gathered
    and broadcast is KEPT words on either side of gaps at most.
    """
    spark = df.sparkSession
    prepare(spark)

    def scan(batches):
        scanner = Scanner()
        for batch in batches:
            packed = [np.array(scanner.scan(t), np.int32).tobytes() if t else b"" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=[key, "gaps"])

    kind_of_key = df.schema[key].dataType.simpleString()
    scanned = stored(columns(df, key, text).mapInArrow(scan, f"{key} {kind_of_key}, gaps binary"), "gaps")

    def counted(first, gaps: DataFrame) -> DataFrame:
        """The counts of all words; given those that went to all workers, without the gaps that they settle."""

        def count(batches):
            one = None if first is None else Tables(first.value)
            low = np.log(SETTLED / (1 - SETTLED))

            def open_still(gap, side):  # by the word on the other side
                return (one.odds(gap, 1 - side) > low) | ((side == 1) & (gap[:, FLAGS] & FULL > 0))

            held, size = [], 0
            for batch in batches:
                rec, _ = records(batch.column(0).to_pylist())
                if batch.num_columns > 1:
                    one.lend(of_batch(batch.column(1)))
                held.append(tally(rec, None if one is None else open_still))
                size += len(held[-1])
                if size > 1_000_000:
                    held = [added(held)]
                    size = 0
            if held:
                total = added(held)
                yield pa.RecordBatch.from_arrays([pa.array(total[c].to_numpy(), t) for c, t in zip(COUNTS, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=COUNTS)

        per_task = gaps.mapInArrow(count, "what int, key long, gaps long, edges long")
        return stored(per_task.groupBy("what", "key").agg(F.sum("gaps").alias("gaps"), F.sum("edges").alias("edges")), "counts")

    def ask(batches):
        one = Tables(first.value)
        for batch in batches:
            rec, of = records(batch.column(1).to_pylist())
            gaps = (rec[:, KIND] == 1) & (rec[:, FLAGS] & FORCED == 0)
            rec, of = rec[gaps], of[gaps]
            for side in (0, 1):
                word = numbers(rec, side)
                other = ~one.own(word, side)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of[other])), pa.array(np.full(other.sum(), BY_WORD[side]), pa.int32()), pa.array(word[other])], names=["digest", *keys])

    def gathered(counts: DataFrame) -> pd.DataFrame:
        return counts.filter((F.col("what") > max(BY_WORD)) | (F.col("gaps") > 0)).toArrow().to_pandas()

    keys = COUNTS[:2]
    all_first = counted(None, scanned.select("gaps"))
    is_word = F.col("what") <= max(BY_WORD)
    every, *sides = all_first.agg(F.sum(F.when((F.col("what") == REST) & (F.col("key") == GAPS), F.col("gaps"))), *[F.count_if((F.col("what") == w) & (F.col("gaps") > 0)) for w in BY_WORD]).first()
    rare = every // KEPT if max(sides) > KEPT else 0
    often = ~is_word | (F.col("gaps") > rare)
    first = spark.sparkContext.broadcast(gathered(all_first.filter(often)))
    if rare:
        rest = all_first.filter(~often & (F.col("gaps") > 0))
        all_second = counted(first, lent(scanned.select("gaps"), "gaps", ask, rest, keys))
        second = gathered(all_second.join(all_first.filter(often).select(*keys), keys, "left_semi"))
        both_of_rest = stored(rest.join(all_second.withColumnsRenamed({"gaps": "gaps2", "edges": "edges2"}), keys, "left").fillna(0), "counts")
        scanned = lent(scanned, "gaps", ask, both_of_rest, keys)
    else:
        all_second = counted(first, scanned.select("gaps"))
        second = gathered(all_second)
    drop(all_first, all_second)
    both = spark.sparkContext.broadcast((first.value, second))

    def cut(batches):
        model = Model(*both.value)
        for batch in batches:
            rec, of = records(batch.column(1).to_pylist())
            if batch.num_columns > 2:
                model.lend(of_batch(batch.column(2)))
            row, start, end = units(rec, of, model.boundaries(rec))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int32()), pa.array(end, pa.int32())], names=[key, "inicio", "fin"])

    return scanned.mapInArrow(cut, f"{key} {kind_of_key}, inicio int, fin int")
