"""Problem 7: filling containers of fixed capacity, shortest pack first over the histogram of lengths."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pliego.llm.spark import columns, prepare, stored

#: Items of one length that are ranked together, on average; a more frequent length is ranked in so many parts.
RANKED = 100_000


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Packing patterns (how many containers, the lengths in each) for so many items of each length.

    Lengths are placed longest first; items go to the pack that is filled least among those with
    room, and what finds no room opens new packs.  Packs of one pattern are kept as one count, so
    the work depends on the capacity, not on the number of items.  A pattern's lengths come as
    (length, how often) pairs in the list.
    """
    by_room: dict[int, list[list]] = {}
    for length in sorted((n for n in histogram if n > 0), reverse=True):
        left, room = histogram[length], capacity
        placed: list[tuple[int, list]] = []
        while left > 0:
            while room >= length and not by_room.get(room):
                room -= 1
            if room < length:
                fit = capacity // length  # new packs, filled with this length alone as far as it goes
                full, rest = divmod(left, fit)
                if full:
                    placed.append((capacity - fit * length, [full, [(length, fit)]]))
                if rest:
                    placed.append((capacity - rest * length, [1, [(length, rest)]]))
                left = 0
                break
            number, pattern = by_room[room].pop()
            take = min(number, left)
            if take < number:
                by_room[room].append([number - take, pattern])
            if number <= left and (more := min(left // number, room // length)) > 1:
                take, each = number, more  # several of them into each of these packs
            else:
                each = 1
            left -= take * each
            placed.append((room - each * length, [take, [*pattern, (length, each)]]))
        for room_left, group in placed:
            by_room.setdefault(room_left, []).append(group)
    return [(number, pattern) for groups in by_room.values() for number, pattern in groups]


def pack(sizes: DataFrame, capacity: int, key: str = "doc_id", size: str = "n_tok") -> DataFrame:
    """`key, pieza, n_tok, contenedor, inicio` of every row of `sizes`.

    An item above the capacity is cut into pieces of the capacity and a last one with the rest
    (`pieza` 0, 1, ...); no other item is cut.  An item of size 0, or null, needs no room: its
    `contenedor` is null and `inicio` 0.  `contenedor` numbers the containers from 0, `inicio` is
    the place of the item in its container.  Repeated keys are items of their own.

    The driver holds only the histogram (at most `capacity` lengths) and the patterns made from it
    (at most two new ones per length).  Items are joined to patterns by rank within their length, which
    is counted in parts of some RANKED items, so that no length is ranked in one task; those of size 0 aren't.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    spark = sizes.sparkSession
    prepare(spark)
    n = F.coalesce(F.col(size).cast("long"), F.lit(0))
    whole = columns(sizes, key, size).select(F.col(key), n.alias("_n"))
    pieces = whole.withColumn("pieza", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.col("_n") - 1) / capacity)).cast("int"))))
    pieces = pieces.select(key, "pieza", F.least(F.lit(capacity), F.col("_n") - F.col("pieza") * F.lit(capacity)).cast("int").alias("n_tok"))
    pieces = stored(pieces, "pieces")
    some = pieces.filter("n_tok > 0")
    histogram = {r.n_tok: r.n for r in some.groupBy("n_tok").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    parts = spark.createDataFrame([(n, -(-many // RANKED)) for n, many in histogram.items()], "n_tok int, _parts int")
    some = some.join(F.broadcast(parts), "n_tok").withColumn("_part", F.pmod(F.xxhash64(key, "pieza"), F.col("_parts")).cast("int")).select(key, "pieza", "n_tok", "_part")

    table = some.groupBy("n_tok", "_part").count().toArrow()  # a row for each length, and for each RANKED items
    lens, part_of, number = (table.column(c).to_numpy() for c in ("n_tok", "_part", "count"))
    offset_key = (lens.astype(np.int64) << np.int64(32)) + part_of
    order = np.argsort(offset_key)
    lens, offset_key, number = lens[order], offset_key[order], number[order].astype(np.int64)
    before = np.cumsum(number) - number
    first = np.concatenate([[True], lens[1:] != lens[:-1]]) if len(lens) else np.zeros(0, bool)
    offset = before - np.repeat(before[first], np.diff(np.concatenate([np.flatnonzero(first), [len(lens)]])))

    # slots: the ranks of one length from `start` on go, one each, into the containers from `base` on, at `place`
    used = dict.fromkeys(histogram, 0)
    slots, base = [], 0
    for many, pattern in shortest_pack_first(histogram, capacity):
        place = 0
        for length, times in pattern:
            slots.append((length, used[length], many, times, base, place))
            used[length] += many * times
            place += length * times
        base += many
    slots.sort()
    s_len, s_start, s_many, s_times, s_base, s_place = (np.array(c, np.int64) for c in zip(*slots)) if slots else (np.zeros(0, np.int64),) * 6
    wide = np.int64(1) << 40
    s_key = s_len * wide + s_start

    def work(batches):
        for batch in batches:
            n, part, rank = (batch.column(k).to_numpy().astype(np.int64) for k in (2, 3, 4))
            r = rank - 1 + offset[np.searchsorted(offset_key, (n << np.int64(32)) + part)]
            at = np.searchsorted(s_key, n * wide + r, side="right") - 1
            inside = r - s_start[at]
            box, start = s_base[at] + inside % s_many[at], s_place[at] + inside // s_many[at] * n
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(box), pa.array(start, pa.int32())], names=[key, "pieza", "n_tok", "contenedor", "inicio"])

    ranked = some.withColumn("_rank", F.row_number().over(Window.partitionBy("n_tok", "_part").orderBy(key, "pieza")))
    schema = T.StructType([sizes.schema[key], T.StructField("pieza", T.IntegerType()), T.StructField("n_tok", T.IntegerType()), T.StructField("contenedor", T.LongType()), T.StructField("inicio", T.IntegerType())])
    none = pieces.filter("n_tok = 0").select(key, "pieza", "n_tok", F.lit(None).cast("long").alias("contenedor"), F.lit(0).alias("inicio"))
    return ranked.select(key, "pieza", "n_tok", "_part", "_rank").mapInArrow(work, schema).unionByName(none)


def waste(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: items, containers, tokens, unused room and its share."""
    per_box = packed.groupBy("contenedor").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tok").alias("t"))
    boxes = F.count("contenedor")
    return per_box.agg(
        F.sum("n").alias("piezas"), boxes.alias("contenedores"), F.coalesce(F.sum("t"), F.lit(0)).alias("tokens"),
        (boxes * capacity - F.coalesce(F.sum("t"), F.lit(0))).alias("libres"),
        F.when(boxes > 0, 1 - F.sum("t") / (boxes * capacity)).alias("fraccion_libre"),
    )
