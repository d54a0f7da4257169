"""Label, prediction and review records as JSON lines; tables with atomic replacement."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pliego.operators.sampling import latest


def read_records(spark: SparkSession, path: str, schema: str, required: bool = True) -> DataFrame:
    """Records in the order of their lines (`seq`); a missing file is empty unless it is required."""
    if not required and not path.startswith(("hdfs:", "s3")) and not os.path.exists(path):
        return spark.createDataFrame([], schema + ", seq long")
    return spark.read.schema(schema).json(path).withColumn("seq", F.monotonically_increasing_id())


def last_by_id(records: DataFrame, order: str = "seq") -> DataFrame:
    """One record per id, the last written."""
    return latest(records, "id", order).drop("seq")


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object a line, with null fields."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_day(df: DataFrame, path: str, day: str) -> bool:
    """A day's partition, written once: False (and nothing done) if it is there or the day is empty."""
    spark = df.sparkSession
    part = f"{path}/fecha={day}"
    fs = spark._jvm.org.apache.hadoop.fs.Path(part).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(part)) or df.isEmpty():
        return False
    df.drop("fecha").write.parquet(part)
    return True
