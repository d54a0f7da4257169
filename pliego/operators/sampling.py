"""Reproducible samples, queues, splits and last writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def order_hash(key: Column, seed: int | str = 42) -> Column:
    """The place of a key in a shuffled order that a seed fixes."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key))


def leading(df: DataFrame, by: list[str], k: int, key: str, seed: int | str = 42) -> DataFrame:
    """The first k rows of each group in hashed order, with their `puesto_azar`.  The constant limit lets every task keep k rows of a group before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(order_hash(F.col(key), seed), key))
    return df.withColumn("puesto_azar", place).filter(F.col("puesto_azar") <= k)


def stratified(df: DataFrame, group: str, quotas: dict[str, int | None], key: str = "id", seed: int | str = 42) -> DataFrame:
    """Of each group its quota of rows in hashed order; all of a group whose quota is None; none of a group without one."""
    whole = [g for g, q in quotas.items() if q is None]
    part = {g: q for g, q in quotas.items() if q is not None}
    out = df.filter(F.col(group).isin(whole))
    if part:
        limit = F.coalesce(*[F.when(F.col(group) == g, F.lit(q)) for g, q in part.items()])
        some = leading(df.filter(F.col(group).isin(*part)), [group], max(part.values()), key, seed)
        out = out.unionByName(some.filter(F.col("puesto_azar") <= limit).drop("puesto_azar"))
    return out


def flag_k(df: DataFrame, group: str, k: int, flag: str, key: str = "id", seed: int | str = 42) -> DataFrame:
    """A flag on k rows of each group; keys are unique.  Only the keys of those k rows a group are ranked and joined back."""
    first = leading(df.select(group, key), [group], k, key, seed).select(key, F.lit(True).alias(flag))
    return df.join(first, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def queued(df: DataFrame, group: str, order: str, key: str, place: str, bucket: int = 12) -> DataFrame:
    """The place of every row within its group by `order` and key, from 1: ranked among rows whose keys begin alike, after the number of rows before those."""
    parts = df.withColumn("_bucket", F.left(key, F.lit(bucket)))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy(order, "_bucket").rowsBetween(Window.unboundedPreceding, -1))
    counts = parts.groupBy(group, order, "_bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (group, order, "_bucket")]
    inner = F.row_number().over(Window.partitionBy(group, order, "_bucket").orderBy(key))
    both = parts.withColumn("_rank", inner).alias("p").join(counts.alias("c"), same)
    return both.select("p.*", (F.col("_rank") + F.col("_before")).cast("long").alias(place)).drop("_rank", "_bucket")


def latest(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The last write of each key: one pass with a partial aggregate, no window over a hot key."""
    rest = [c for c in df.columns if c != key]
    top = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return df.groupBy(key).agg(top).select(key, "_last.*")


def pending(df: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    return df.join(done.select(key), key, "left_anti")


def matched(wanted: DataFrame, found: DataFrame, key: str = "id") -> DataFrame:
    """`found` for every wanted key, strictly: raises if a key is missing."""
    lost = [r[0] for r in wanted.select(key).join(found.select(key), key, "left_anti").limit(20).collect()]
    if lost:
        raise KeyError(f"missing: {lost}")
    return found.join(wanted.select(key).distinct(), key, "left_semi")


def is_validation(key: Column, share: int = 50) -> Column:
    """Whether md5(key) mod 1000 is below `share`: the 128 bits are folded by their four words (2^32 mod 1000 = 296)."""
    h, acc = F.md5(key), F.lit(0).cast("long")
    for k in range(4):
        acc = (acc * 296 + F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("long")) % 1000
    return acc < share
