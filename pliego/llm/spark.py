"""What the operators of this subpackage share about the Spark session."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pliego.plans.session import ship

#: Rows and bytes of one Arrow batch handed to a Python worker.  Texts are a few KB each; a batch
#: stays at some MB, so that two workers and the heap fit into a small executor.
ARROW_ROWS = 2000
ARROW_BYTES = 16 * 1024 * 1024


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session and give its workers the package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.  Only a session within one machine (tests) gets one of
    our own where it is unset; on a cluster a local folder would lose data, so that raises."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="pliego-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_PATHS: dict[str, object] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A path for a new table in the shared folder, which goes with the driver's process at the latest."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _PATHS:
        atexit.register(lambda: remove(*_PATHS))
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    _PATHS[path] = (where.getFileSystem(spark._jsc.hadoopConfiguration()), where)
    return path


def remove(*paths: str) -> None:
    """Deletes tables that nothing will read any more."""
    for path in paths:
        if held := _PATHS.pop(path, None):
            try:
                held[0].delete(held[1], True)
            except Exception:  # the session's JVM is gone
                pass


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: its lineage is cut, and the loss of an
    executor costs no recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes tables made by `stored`, once nothing reads them any more."""
    remove(*[t._scratch for t in tables])


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns (whatever their names) play no part."""
    return df.select(*[df[n] for n in names])


def lent(df: DataFrame, column: str, ask, of: DataFrame, keys: list[str]) -> DataFrame:
    """The columns of `df`, named c0 and so on, with `lent`: of each row, the rows of `of` whose `keys` are among those that its value in `column` asks for.

    `ask` makes batches of (digest, *keys) of batches of (digest, value).  Rows meet by 64 bits of the value: values
    that share them are lent each other's rows too, so what is lent must hold by its keys alone.
    """
    digest = F.xxhash64(df[column])
    wanted = df.select(digest.alias("digest"), df[column].alias("value")).mapInArrow(ask, "digest long, " + ", ".join(f"{k} {of.schema[k].dataType.simpleString()}" for k in keys)).distinct()
    found = wanted.join(of, keys).groupBy("digest").agg(F.collect_list(F.struct(*of.columns)).alias("lent"))
    return df.join(found, digest == found["digest"], "left").select(*[df[c].alias(f"c{k}") for k, c in enumerate(df.columns)], found["lent"])
