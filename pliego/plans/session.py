"""A session with the settings this engine counts on."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI and adaptive execution (coalescing, skewed joins); masters and sizes are left to the cluster."""
    b = SparkSession.builder.appName("pliego")
    if master:
        b = b.master(master)
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true"}
    for k, v in {**base, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers of the session, once: the driver serves it to executors that don't have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_pliego_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="pliego-"), "pliego.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("pliego", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._pliego_shipped = True
