"""Problem 1: records of evaluation splits that also stand, exactly or almost, in the training split.

Texts are normalised to words and words to symbols.  The passages of an evaluation text are all its runs of
three words, which are also what likeness counts.  Evaluation texts lie in shards of bounded size; each shard
becomes an Aho-Corasick automaton of all its passages that scans all training texts once, many stretches of them
in step.  The matches are everything that is needed: the passages of a record found in a training text are the runs they have in common,
so their number gives the likeness, and the intervals where they stand, merged, the coverage of the record.

No pair is left out: two texts whose common runs are at least LIKE of the record's cannot miss more than the rest
of them, so of any passages beyond that rest, `wanted` more, at least `wanted` are found.  Records are met by
their passages that the fewest records of the shard have, that many, and only those met are counted in full.
"""

from __future__ import annotations

import hashlib
import json
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pliego.llm.spark import columns, prepare, remove, scratch, stored
from pliego.llm.words import LIKE, RUN, WordHash, digest, mix, runs

#: Words of the records of one shard, of some 230 bytes each on a worker (320 while it is built) if no two passages are equal; a text with more
#: is a shard of its own.
SHARD_WORDS = 3_000_000
#: Buckets of records per shard, which are put together to shards by their size.
BUCKETS = 16
#: Words scanned at once, and pairs of (text, record) gathered at once unless one text alone has more.
BLOCK, GATHERED = 200_000, 2_000_000
#: Words of a stretch.
STRETCH = 32
#: Bits of a word's symbol, and the symbol after a text, which is no word's.
BITS, END = 21, 1 << 21


def symbols(numbers: np.ndarray) -> np.ndarray:
    """A symbol of BITS bits for each word.  Words may share one of two millions; three in a row hardly do."""
    return (mix(numbers) & np.uint64((1 << BITS) - 1)).astype(np.uint32)


def passages(code: np.ndarray) -> np.ndarray:
    """One number for each run of three symbols, in order."""
    c = code.astype(np.uint64)
    return (c[:-2] << np.uint64(2 * BITS)) | (c[1:-1] << np.uint64(BITS)) | c[2:] if len(c) >= RUN else np.zeros(0, np.uint64)


def canonical(text: str | None) -> str | None:
    """A digest of a JSON value: keys in order, null members left out, numbers by value.  None for a null, a JSON null and what isn't JSON: such equal nothing."""
    if text is None:
        return None
    try:
        value = json.loads(text, parse_int=number, parse_float=number)
        if value is None:
            return None
        return hashlib.md5(repr(_plain(value)).encode("utf-8", "surrogatepass")).hexdigest()
    except (ValueError, RecursionError, ArithmeticError):
        return None


def number(text: str):
    """A JSON number by its exact value, however it is written: 12 and 12.0, 1e16 and 10000000000000000 are one."""
    if len(text) < 16 and text.isdigit():
        return int(text)
    sign, digits, exponent = Decimal(text).as_tuple()
    shown = "".join(map(str, digits)).lstrip("0")
    kept = shown.rstrip("0")
    exponent += len(shown) - len(kept)
    if kept and exponent >= 0 and len(kept) + exponent < 16:
        return (-1 if sign else 1) * int(kept) * 10**exponent
    return ("number", sign, kept, exponent) if kept else 0


def _plain(v):
    if isinstance(v, dict):
        return {k: _plain(v[k]) for k in sorted(v) if v[k] is not None}
    return [_plain(x) for x in v] if isinstance(v, list) else v


def wanted(distinct):
    """How many of its rarest passages a record must be met by: a sixteenth, one at least; the more, the fewer records are counted in vain."""
    return np.maximum(1, distinct // 16)


def leading(distinct):
    """How many passages that takes: what a like text may lack, and `wanted`."""
    return distinct - np.ceil(LIKE * distinct - 1e-9).astype(np.int64) + wanted(distinct)


def normalised(df: DataFrame, key: str, split: str, text: str, doc: str) -> DataFrame:
    """`row, eval, same, value, numbers`: the side, the digest of the set of runs (null below three words), the digest of the JSON value, the words' numbers."""

    def work(batches):
        number = WordHash()
        for batch in batches:
            side, same, value, packed = [], [], [], []
            for s, t, j in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                n = number.numbers(t) if t else np.zeros(0, np.uint32)
                side.append(s != "train")
                some = len(n) >= RUN
                same.append(digest(once(runs(n))) if some else None)
                packed.append(n.tobytes() if some else None)
                value.append(canonical(j))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(side, pa.bool_()), pa.array(same, pa.int64()), pa.array(value, pa.string()), pa.array(packed, pa.binary())], names=["row", "eval", "same", "value", "numbers"])

    rows = columns(df, key, split, text, doc).filter(F.col(split).isin("train", "validation", "test"))
    return rows.withColumn(key, F.col(key).cast("long")).mapInArrow(work, "row long, eval boolean, same long, value string, numbers binary")


def overlap(df: DataFrame, key: str = "row_id", split: str = "split", text: str = "texto", doc: str = "json", shard_words: int = SHARD_WORDS) -> dict[str, DataFrame]:
    """Cross-split overlaps of one table of records.

    `rows`: `row, eval, same, value`: the record, whether it is one of validation or test, the class of records with the same
    set of runs, the digest of its JSON value.  `links`: `train, eval`: classes of like texts.  `coverage`: `same, palabras,
    cubiertas` of every class of evaluation records with three words or more: its words, and those inside its passages found
    in training texts that hold LIKE of its passages or more (so also in longer texts that aren't like it); 0 if there are none.

    Texts with fewer than three words are like nothing; a null, unreadable or `null` JSON equals nothing; rows of another or no
    split play no part; repeated rows are rows of their own.  Copies (equal sets of runs) are known by their digest: one of
    them is scanned per task, one stands in a shard, and `pairs` joins all of them back.  The driver holds one shard at a time.
    """
    spark = df.sparkSession
    prepare(spark)
    rows = stored(normalised(df, key, split, text, doc), "normalised")
    some = rows.filter("same is not null")
    test = some.filter("eval").select("same", "numbers")

    # shards of about shard_words words: one text of each class, as symbols
    words = test.agg(F.coalesce(F.sum(F.length("numbers") / 4), F.lit(0))).first()[0]
    buckets = BUCKETS * max(1, math.ceil(words / shard_words))

    def cut(batches):
        for batch in batches:
            code = [symbols(np.frombuffer(raw, np.uint32)) for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(map(len, code), pa.int32())], names=["same", "code", "palabras"])

    shape = "same long, code binary, palabras int, bucket int"
    one = test.groupBy("same").agg(F.min("numbers").alias("numbers")).mapInArrow(cut, "same long, code binary, palabras int")
    shard_path = scratch(spark, "shards")
    one.withColumn("bucket", F.pmod(F.xxhash64("same"), F.lit(buckets)).cast("int")).repartition("bucket").write.partitionBy("bucket").option("compression", "zstd").parquet(shard_path)
    sharded = spark.read.schema(shape).parquet(shard_path)
    sizes = stored(sharded.select("same", "palabras", "bucket"), "sizes")
    shards: list[list[int]] = []
    room = 0
    for bucket, n in sorted((r.bucket, r.n) for r in sizes.groupBy("bucket").agg(F.sum("palabras").alias("n")).collect()):
        if n > room:
            shards.append([])
            room = shard_words
        shards[-1].append(bucket)
        room -= n

    found_path = scratch(spark, "found")
    schema = "train long, eval long, at int, bits long"
    train = some.filter("not eval").select("same", "numbers")
    for shard in shards:
        part = sharded.filter(F.col("bucket").isin(shard)).select("same", "code").toArrow()
        payload = spark.sparkContext.broadcast((part.column("same").to_numpy(), part.column("code").to_pylist()))
        train.mapInArrow(_scanner(payload, f"{found_path}/{shard[0]}"), schema).write.mode("append").parquet(found_path)
        payload.destroy()
    remove(shard_path)
    found = spark.read.schema(schema).parquet(found_path) if shards else spark.createDataFrame([], schema)

    covered = found.filter("at is not null").groupBy("eval", "at").agg(F.bit_or("bits").alias("bits")).groupBy("eval").agg(F.sum(F.bit_count("bits")).cast("int").alias("cubiertas"))
    coverage = sizes.join(covered.withColumnRenamed("eval", "same"), "same", "left").select("same", "palabras", F.coalesce("cubiertas", F.lit(0)).alias("cubiertas"))
    return {"rows": rows.drop("numbers"), "links": found.filter("at is null").select("train", "eval").distinct(), "coverage": coverage}


def pairs(rows: DataFrame, links: DataFrame) -> DataFrame:
    """`train, eval, texto, json`: one row per pair of rows, one of split train and one of validation or test, whose texts have a likeness of LIKE or more or whose JSON values are equal."""
    side = lambda by, test, name, to: rows.filter(F.col(by).isNotNull() & (F.col("eval") == test)).select(F.col(by).alias(name), F.col("row").alias(to))
    alike = links.join(side("same", False, "train", "t"), "train").join(side("same", True, "eval", "e"), "eval")
    alike = alike.select(F.col("t").alias("train"), F.col("e").alias("eval"), F.lit(True).alias("texto"), F.lit(False).alias("json"))
    equal = side("value", False, "value", "train").join(side("value", True, "value", "eval"), "value").select("train", "eval", F.lit(False).alias("texto"), F.lit(True).alias("json"))
    return alike.unionByName(equal).groupBy("train", "eval").agg(F.max("texto").alias("texto"), F.max("json").alias("json"))


def once(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


class Automaton:
    """The Aho-Corasick automaton of some passages (sorted, distinct), as arrays.

    Node 0 is the root; then come first words, pairs of words, and the passages, whose nodes are leaves.  `root` has
    where each symbol leads from the root, a hash table where it leads from other nodes, `fail` each node's failure link.
    """

    def __init__(self, passage: np.ndarray):
        last = np.uint64(BITS)
        pair, pair_of = numbered(passage >> last)
        first, first_of = numbered(pair >> last)
        pairs, self.leaf = 1 + len(first), 1 + len(first) + len(pair)
        self.root = np.zeros(END + 1, np.int32)
        self.root[first.astype(np.int64)] = np.arange(1, pairs)
        symbol = np.concatenate([pair, passage]).astype(np.int64) & (END - 1)
        key = self.key(np.concatenate([1 + first_of, pairs + pair_of]), symbol)
        order = np.argsort(key)
        self.keys, self.to = key[order], (pairs + order).astype(np.int32)
        bits = len(key).bit_length() + 1  # two to four slots for each
        self.shift = np.uint64(64 - bits)
        self.slot = np.zeros((1 << bits) + 1, np.int32)  # where the keys with these first bits begin
        np.cumsum(np.bincount((self.keys >> self.shift).astype(np.int64), minlength=1 << bits), out=self.slot[1:])
        self.fail = np.zeros(self.leaf + len(passage), np.int32)
        self.fail[pairs : self.leaf] = self.root[symbol[: len(pair)]]
        self.fail[self.leaf :] = self.next(self.fail[pairs : self.leaf][pair_of], symbol[len(pair) :])

    @staticmethod
    def key(node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """One number for both, spread over all of 64 bits; by an odd factor, so that no two become one."""
        return ((node.astype(np.int64) << (BITS + 1)) | symbol).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def goto(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The nodes that symbols lead to from nodes other than the root, 0 where there is none."""
        key = self.key(node, symbol)
        slot = (key >> self.shift).astype(np.int64)
        at, end = self.slot[slot], self.slot[slot + 1]
        to = np.zeros(len(key), np.int32)
        left = np.flatnonzero(at < end)
        while len(left):
            here = at[left]
            equal = self.keys[here] == key[left]
            to[left[equal]] = self.to[here[equal]]
            left = left[~equal]
            at[left] += 1
            left = left[at[left] < end[left]]
        return to

    def next(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The states after a symbol each: by the node itself, or else by the first that its failure links lead to."""
        after = self.root[symbol]
        left = np.flatnonzero(state)
        node = state[left]
        while len(left):
            to = self.goto(node, symbol[left])
            after[left] = np.where(to, to, after[left])
            node = self.fail[node[to == 0]]
            left = left[to == 0][node > 0]
            node = node[node > 0]
        return after

    def read(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the passages of some texts begin, each text with END after it, and which they are, in no order.

        Stretches are read in step, each with the two words before it, so that every passage ends in one of them.
        """
        before = RUN - 1
        padded = np.full(before + -(-len(code) // STRETCH) * STRETCH, END, np.int64)
        padded[before : before + len(code)] = code
        words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, STRETCH + before)[::STRETCH].T)
        state = np.zeros(words.shape[1], np.int32)
        place, passage = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, symbol in enumerate(words):
            state = self.next(state, symbol)
            found = np.flatnonzero(state >= self.leaf)
            place.append(found * STRETCH + (k - 2 * before))
            passage.append(state[found].astype(np.int64) - self.leaf)
            state[found] = self.fail[state[found]]  # nothing leads on from a leaf
        return np.concatenate(place), np.concatenate(passage)


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of sorted values, and the number of each value among them."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new], np.cumsum(new) - 1


class Shard:
    """The automaton of one shard's passages, and which records have them."""

    def __init__(self, ids: np.ndarray, codes: list[bytes]):
        self.ids = ids
        runs_of = [passages(np.frombuffer(c, np.uint32)) for c in codes]
        self.start = np.concatenate([[0], np.cumsum([len(r) for r in runs_of])]).astype(np.int64)
        flat = np.concatenate([*runs_of, np.zeros(0, np.uint64)])
        order = np.argsort(flat)
        distinct, number = numbered(flat[order])
        self.size, self.records = len(distinct), len(ids)
        self.at = np.empty(len(flat), np.int32)  # the passages of each record, in order
        self.at[order] = number
        owner = np.repeat(np.arange(self.records), np.diff(self.start))
        held = once(owner * max(1, self.size) + self.at)
        self.of, which = held // max(1, self.size), held % max(1, self.size)
        self.which = which.astype(np.int32)  # those of each record, once each
        self.first = np.searchsorted(self.of, np.arange(self.records + 1))
        self.distinct = np.diff(self.first)
        often = np.bincount(which, minlength=self.size)
        order = np.argsort((self.of.astype(np.uint64) << np.uint64(40)) | (np.minimum(often[which], (1 << 20) - 1).astype(np.uint64) << np.uint64(20)) | (mix(which) >> np.uint64(44)))
        rank = np.arange(len(order)) - self.first[self.of[order]]
        lead = order[rank < leading(self.distinct)[self.of[order]]]
        lead = lead[np.argsort(which[lead], kind="stable")]
        self.owner = self.of[lead].astype(np.int32)
        self.owned = np.searchsorted(which[lead], np.arange(self.size + 1))
        self.wanted = wanted(self.distinct)
        self.machine = Automaton(distinct)
        self.mask = np.zeros(self.size, bool)
        self.covered: dict[int, np.ndarray] = {}

    def met(self, text: np.ndarray, passage: np.ndarray):
        """(text, record) pairs that meet, of the distinct (text, passage) matches sorted by text."""
        number = self.owned[passage + 1] - self.owned[passage]
        total = np.cumsum(number)
        a = 0
        while a < len(text):
            b = max(int(np.searchsorted(total, (total[a - 1] if a else 0) + GATHERED, side="right")), a + 1)
            b = int(np.searchsorted(text, text[b], side="left")) if b < len(text) and text[b] != text[a] else int(np.searchsorted(text, text[b - 1], side="right"))
            n = number[a:b]
            at = np.repeat(self.owned[passage[a:b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            each = np.sort(np.repeat(text[a:b], n) * self.records + self.owner[at])
            new = np.flatnonzero(np.diff(each, prepend=-1))
            pair, hits = each[new], np.diff(new, append=len(each))
            pair = pair[hits >= self.wanted[pair % self.records]]
            yield from zip((pair // self.records).tolist(), (pair % self.records).tolist())
            a = b

    def scan(self, numbers: list[np.ndarray]):
        """(text, record) of the like ones among some training texts, given as their words' numbers; notes what they cover."""
        begin = np.cumsum([0, *[len(n) + 1 for n in numbers]])
        code = np.full(begin[-1], END, np.uint32)
        word = np.ones(begin[-1], bool)
        word[begin[1:] - 1] = False
        code[word] = symbols(np.concatenate(numbers))
        place, passage = self.machine.read(code)
        each = once(((np.searchsorted(begin, place, side="right") - 1) << 32) | passage)
        text, passage = each >> 32, each & ((1 << 32) - 1)
        of_text = np.searchsorted(text, np.arange(len(begin)))
        last = None
        for t, record in self.met(text, passage):
            mine = passage[of_text[t] : of_text[t + 1]]
            if t != last:
                if last is not None:
                    self.mask[passage[of_text[last] : of_text[last + 1]]] = False
                self.mask[mine] = True
                last, size = t, len(once(passages(code[begin[t] : begin[t + 1] - 1])))
            distinct = int(self.distinct[record])
            common = int(self.mask[self.which[self.first[record] : self.first[record + 1]]].sum())
            if common >= LIKE * distinct - 1e-9:
                self.cover(record)
            if common / (size + distinct - common) >= LIKE:
                yield t, record
        if last is not None:
            self.mask[passage[of_text[last] : of_text[last + 1]]] = False

    def cover(self, record: int) -> None:
        """Adds the intervals of the passages that have been found to what is covered of the record's words."""
        if (word := self.covered.get(record)) is None:
            word = self.covered[record] = np.zeros(int(self.start[record + 1] - self.start[record]) + RUN - 1, bool)
        if not word.all():
            at = np.flatnonzero(self.mask[self.at[self.start[record] : self.start[record + 1]]])
            for k in range(RUN):
                word[at + k] = True

    def coverage(self):
        """(record, place, 64 words as bits) of what has been covered, and forgets it."""
        for record, word in self.covered.items():
            bits = np.packbits(word, bitorder="little")
            bits = np.concatenate([bits, np.zeros(-len(bits) % 8, np.uint8)]).view("<i8")
            at = np.flatnonzero(bits)
            yield record, at, bits[at]
        self.covered.clear()


_SHARD: dict[str, Shard] = {}


def _scanner(payload, name: str):
    """Scans training texts with one shard's automaton, which the worker keeps until it gets another.  Rows are (class of training texts, class of evaluation texts), or, with a place, what is covered."""

    def work(batches):
        if name not in _SHARD:
            _SHARD.clear()
            _SHARD[name] = Shard(*payload.value)
        shard = _SHARD[name]
        shard.covered.clear()
        done: set[int] = set()  # repeats work where there are more: the same links come out again

        def scanned(same, numbers):
            for t, record in shard.scan(numbers):
                yield same[t], shard.ids[record]

        def rows(train, evals, at=None, bits=None):
            n = len(evals)
            return pa.RecordBatch.from_arrays([pa.array(train, pa.int64()), pa.array(evals, pa.int64()), pa.array(at if at is not None else [None] * n, pa.int32()), pa.array(bits if bits is not None else [None] * n, pa.int64())], names=["train", "eval", "at", "bits"])

        for batch in batches:
            links, same, numbers, size = [], [], [], 0
            for s, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if s in done or not shard.size:
                    continue
                if len(done) < 200_000:
                    done.add(s)
                same.append(s), numbers.append(np.frombuffer(raw, np.uint32))
                size += len(numbers[-1])
                if size > BLOCK:
                    links += scanned(same, numbers)
                    same, numbers, size = [], [], 0
            if numbers:
                links += scanned(same, numbers)
            yield rows([a for a, _ in links], [b for _, b in links])
        for record, at, bits in shard.coverage():
            yield rows([None] * len(at), [shard.ids[record]] * len(at), at, bits)

    return work


def report(df: DataFrame, rows: DataFrame, links: DataFrame, coverage: DataFrame, key: str = "row_id", split: str = "split", source: str = "etiqueta") -> DataFrame:
    """Overlaps per evaluation split and source: its rows, those with an overlap by text, by JSON and by either, the pairs of rows, and the mean share of words covered in rows of three words or more.

    Pairs are counted by the sizes of classes, never made: those by text, and by JSON, less those by both.
    """
    train = rows.filter("not eval").groupBy("same", "value").agg(F.count(F.lit(1)).alias("n"))
    linked = links.join(train.withColumnRenamed("same", "train"), "train").groupBy("eval", "value").agg(F.sum("n").alias("n"))
    by_text = linked.groupBy(F.col("eval").alias("same")).agg(F.sum("n").alias("n_texto"))
    by_json = train.filter("value is not null").groupBy("value").agg(F.sum("n").alias("n_json"))
    by_both = linked.filter("value is not null").select(F.col("eval").alias("same"), "value", F.col("n").alias("n_ambos"))
    named = columns(df, key, split, source).filter(F.col(split).isin("validation", "test")).select(F.col(key).cast("long").alias("row"), F.col(split).alias("split"), F.col(source).alias("etiqueta"))
    some = named.join(rows.filter("eval").select("row", "same", "value"), "row").groupBy("split", "etiqueta", "same", "value").agg(F.count(F.lit(1)).alias("m"))
    some = some.join(by_text, "same", "left").join(by_json, "value", "left").join(by_both, ["same", "value"], "left").join(coverage, "same", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    n = zero("n_texto") + zero("n_json") - zero("n_ambos")
    rows_if = lambda c: F.sum(F.when(c, F.col("m")).otherwise(0))
    share = F.sum(F.col("m") * F.col("cubiertas") / F.col("palabras")) / F.sum(F.when(F.col("palabras").isNotNull(), F.col("m")))
    return some.groupBy("split", "etiqueta").agg(
        F.sum("m").alias("filas"), rows_if(n > 0).alias("solapadas"), rows_if(zero("n_texto") > 0).alias("por_texto"), rows_if(zero("n_json") > 0).alias("por_json"),
        F.sum(F.col("m") * n).alias("pares"), F.round(share, 6).alias("cobertura"),
    )
