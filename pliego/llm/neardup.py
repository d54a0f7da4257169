"""Problem 4: groups of records that differ by small edits, by pigeonring filtering over sketches.

A record's set of word runs becomes a sketch of M minimum hashes, whose Hamming distance to another sketch
estimates how unlike the two sets are.  The sketch lies on a ring, cut into segments of WIDTH symbols.  Two
records within TAU differences have chains of consecutive segments along the ring whose differences, summed
from the chain's first segment on, never exceed the share of TAU that falls to so many segments.  The first
segment of a chain is one where both are equal, at any multiple of STEP symbols (so the ring is cut in WIDTH /
STEP ways): there records meet in a join, in which the chain test runs over CHAIN segments that travel with the
key.  What passes is compared by its whole sketch, and what is within TAU by the sets themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pliego.llm.spark import columns, drop, prepare, stored
from pliego.llm.words import LIKE, WordHash, digest, likeness, mix, runs

#: Symbols of a sketch, of one segment, and from one place where a chain may start to the next.
M, WIDTH, STEP = 128, 4, 2
SEGMENTS, STARTS = M // WIDTH, M // STEP
#: Most differing symbols between two sketches.  A pair of likeness 0.60 differs in 51 on average (deviation 5.5), so one in ten thousand of those goes beyond.
TAU = 72
#: Segments after the equal one that travel with a key, in longs of LONG segments, four bits a symbol (of which one in 16 that differs looks equal).
CHAIN, LONG = 8, 4
#: Bits of the bitmap of records to read again: 8 MB, whatever the data.
BITS = 1 << 26


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    s = mix(np.arange(1, 2 * M + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (s[:M] | np.uint64(1)).astype(np.uint32) | np.uint32(1), s[M:].astype(np.uint32)


_A, _B = _seeds()


def sketch(distinct: np.ndarray) -> np.ndarray:
    """M minimum hashes of a set of runs."""
    x = (distinct >> np.uint64(32)).astype(np.uint32) ^ distinct.astype(np.uint32)
    low = np.full(M, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 4096):
        h = x[None, at : at + 4096] * _A[:, None]
        h ^= h >> np.uint32(15)
        h += _B[:, None]
        h *= np.uint32(0x2C1B3C6D)
        np.minimum(low, h.min(1), out=low)
    return low


def band(sk: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sketches (rows of M symbols of 16 bits) a key for each place where a chain may start, and the segments after it as longs."""
    ring = np.concatenate([sk, sk[:, : (CHAIN + 1) * WIDTH]], 1).astype(np.uint64)
    at = np.arange(STARTS)[:, None] * STEP
    first = ring[:, at + np.arange(WIDTH)]
    key = np.zeros(first.shape[:2], np.uint64)
    for k in range(WIDTH):
        key = (key << np.uint64(16)) | first[:, :, k]
    key = mix(key + np.arange(STARTS, dtype=np.uint64))
    after = ring[:, at + WIDTH + np.arange(CHAIN * WIDTH)] & np.uint64(15)
    chain = np.zeros((*first.shape[:2], CHAIN // LONG), np.uint64)
    for k in range(LONG * WIDTH):
        chain = (chain << np.uint64(4)) | after[:, :, k :: LONG * WIDTH]
    return key.astype(np.int64), chain.astype(np.int64)


def sketches(df: DataFrame, key: str, texts: list[str]) -> DataFrame:
    """`key, same` of every row, `same` being the digest of its set of runs (null below three words);
    and once per digest and task `sk`, the sketch's symbols by 16 bits."""

    def work(batches):
        number, seen = WordHash(), set()
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(1, len(texts) + 1)]
            same, sk = [], []
            for parts in zip(*cols):
                d = distinct_runs(number, parts)
                same.append(digest(d) if len(d) else None)
                if same[-1] is None or same[-1] in seen:
                    sk.append(None)
                    continue
                if len(seen) < 200_000:  # repeats work where there are more
                    seen.add(same[-1])
                sk.append(sketch(d).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.int64()), pa.array(sk, pa.binary())], names=[key, "same", "sk"])

    return columns(df, key, *texts).mapInArrow(work, f"{key} {df.schema[key].dataType.simpleString()}, same long, sk binary")


def distinct_runs(number: WordHash, parts: tuple) -> np.ndarray:
    """The distinct runs, sorted, of texts joined by line breaks; nulls are empty."""
    d = np.sort(runs(number.numbers("\n".join(p or "" for p in parts))))
    return d[np.concatenate([[True], d[1:] != d[:-1]])] if len(d) else d


def differing(x: Column) -> Column:
    """How many of a long's groups of four bits aren't 0."""
    x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
    return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))


def chained(a: list[Column], b: list[Column]) -> Column:
    """The chain test: each prefix of the chain, the first segment of which is equal, is within its share of TAU."""
    ok, before = None, F.lit(0)
    for k, (x, y) in enumerate(zip(a, b)):
        x = x.bitwiseXOR(y)
        for j in range(1, LONG + 1):
            share = (k * LONG + j + 1) * TAU // SEGMENTS
            if share >= (k * LONG + j) * WIDTH:
                continue  # so many can't differ
            number = before + differing(F.shiftrightunsigned(x, 4 * WIDTH * (LONG - j)) if j < LONG else x)
            ok = number <= share if ok is None else ok & (number <= share)
        before = before + differing(x)
    return ok


def bitmap(df: DataFrame, col: str) -> np.ndarray:
    """A bitmap of fixed size of the values of `col`: what isn't in it isn't among them."""
    at = df.select(F.pmod(F.xxhash64(col), F.lit(BITS)).alias("at"))
    table = at.selectExpr("int(at div 64) AS w", "shiftleft(1L, int(at % 64)) AS b").groupBy("w").agg(F.expr("bit_or(b)").alias("b")).toArrow()
    bits = np.zeros(BITS // 64, np.int64)
    bits[table.column("w").to_numpy()] = table.column("b").to_numpy()
    return bits.view(np.uint64)


def near_duplicates(df: DataFrame, key: str = "id", titulo: str = "titulo", texto: str = "texto") -> dict[str, DataFrame]:
    """Records of likeness LIKE or more, of the title, a line break and the text.

    `members`: `key, same`: each record with a text that isn't blank and three words at least, and
    the class of records with the same set of runs.  `links`: `same_a, same_b`: pairs of different
    classes that are alike.  `pairs`: `id_a, id_b`: both of them over all records, smaller key first.

    Records without a key or with a blank text play no part; rows of one key count once (by their
    least class, should they differ); a text of fewer than three words is like nothing; a null title
    is empty.  The only loss is that of the sketch: a pair of likeness 0.60 is missed with a probability
    of 0.001, of 0.62 of 0.0004, of 0.65 of 0.0001 (equal segment, chain and TAU together).
    """
    spark = df.sparkSession
    prepare(spark)
    rows = columns(df, key, titulo, texto).filter(F.col(key).isNotNull() & F.col(texto).rlike(r"(?U)\S"))
    made = stored(sketches(rows, key, [titulo, texto]), "sketches")
    members = stored(made.filter("same is not null").groupBy(key).agg(F.min("same").alias("same")), "members")

    # where chains may start, once per class
    classes = stored(made.filter("sk is not null").select("same", "sk").dropDuplicates(["same"]), "classes")
    drop(made)
    longs = [f"c{k}" for k in range(CHAIN // LONG)]

    def bands(batches):
        for batch in batches:
            keys, chain = band(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, M))
            same = np.repeat(batch.column(0).to_numpy(), STARTS)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (same, keys.reshape(-1), *np.moveaxis(chain, 2, 0).reshape(len(longs), -1))], names=["same", "k", *longs])

    banded = classes.mapInArrow(bands, "same long, k long, " + ", ".join(f"{c} long" for c in longs))
    a, b = banded.alias("a"), banded.alias("b")
    col = lambda name: F.col(name)
    met = a.join(b, (col("a.k") == col("b.k")) & (col("a.same") < col("b.same")) & chained([col(f"a.{c}") for c in longs], [col(f"b.{c}") for c in longs]))
    met = met.select(col("a.same").alias("same_a"), col("b.same").alias("same_b")).distinct()

    def within(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, M) for k in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["same_a", "same_b"]).filter(pa.array((x != y).sum(1) <= TAU))

    sk = lambda s: classes.select(F.col("same").alias("same" + s), F.col("sk").alias("sk" + s))
    near = stored(met.join(sk("_a"), "same_a").join(sk("_b"), "same_b").select("same_a", "same_b", "sk_a", "sk_b").mapInArrow(within, "same_a long, same_b long"), "near")

    # the whole sets of the classes that are left, from one record of each: a bitmap lets pass nearly only these
    needed = near.select(F.explode(F.array("same_a", "same_b")).alias("same")).distinct()
    first = members.join(needed, "same", "left_semi").groupBy("same").agg(F.min(key).alias(key))
    bits = spark.sparkContext.broadcast(bitmap(first, key))

    def again(batches):
        number, seen = WordHash(), set()
        for batch in batches:
            at = batch.column(2).to_numpy()
            same, sets = [], []
            for k in np.flatnonzero((bits.value[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)).tolist():
                d = distinct_runs(number, (batch.column(0)[k].as_py(), batch.column(1)[k].as_py()))
                s = digest(d) if len(d) else None
                if s is not None and s not in seen:
                    if len(seen) < 200_000:
                        seen.add(s)
                    same.append(s), sets.append(d.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(same, pa.int64()), pa.array(sets, pa.binary())], names=["same", "runs"])

    source = rows.select(titulo, texto, F.pmod(F.xxhash64(key), F.lit(BITS)).alias("at"))
    whole = stored(source.mapInArrow(again, "same long, runs binary").join(needed, "same", "left_semi").dropDuplicates(["same"]), "whole")
    runs_of = lambda s: whole.select(F.col("same").alias("same" + s), F.col("runs").alias("runs" + s))
    both = near.join(runs_of("_a"), "same_a").join(runs_of("_b"), "same_b").select("same_a", "same_b", "runs_a", "runs_b")

    def exact(batches):
        for batch in batches:
            keep = [likeness(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= LIKE for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["same_a", "same_b"]).filter(pa.array(keep, pa.bool_()))

    links = stored(both.mapInArrow(exact, "same_a long, same_b long"), "links")
    drop(classes, near, whole)

    of = lambda s: members.select(F.col(key).alias("id" + s), F.col("same").alias("same" + s))
    across = links.join(of("_a"), "same_a").join(of("_b"), "same_b").select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
    several = members.groupBy("same").count().filter("count > 1").select("same")
    group = members.join(several, "same", "left_semi")
    g, h = group.alias("g"), group.alias("h")
    same_set = g.join(h, (col("g.same") == col("h.same")) & (col(f"g.{key}") < col(f"h.{key}"))).select(col(f"g.{key}").alias("id_a"), col(f"h.{key}").alias("id_b"))
    return {"members": members, "links": links, "pairs": across.unionByName(same_set)}
