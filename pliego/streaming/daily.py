"""The daily product, as a batch of one day and as an incremental stream over arriving days."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pliego.operators.classify import classify
from pliego.operators.rules import extract
from pliego.operators.validate import errors


class Extractor(Protocol):
    """A model backend: JSON texts for (tipo, titulo, departamento, texto) rows; loaded once per worker."""

    def __call__(self, rows: Iterator[tuple[str, str, str, str]]) -> Iterator[str | None]: ...


def run_model(df: DataFrame, load: Callable[[], Extractor]) -> DataFrame:
    """`id, tipo, json` by a pluggable model, in Arrow batches; `load` runs once per task."""
    import pyarrow as pa

    def work(batches):
        model = load()
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(1, 5)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(model(rows)), pa.string())], names=["id", "tipo", "json"])

    return df.select("id", "tipo", "titulo", "departamento", "texto").mapInArrow(work, "id string, tipo string, json string")


def day(summary: DataFrame, documents: DataFrame, extractor: Callable[[DataFrame], DataFrame] = extract) -> DataFrame:
    """Extractions of a day's candidates whose document was found, with `error` (null if valid)."""
    found = classify(summary).join(documents.select("id", "texto"), "id", "inner")
    made = extractor(found.select("id", "tipo", "subtipo", "titulo", "departamento", "texto"))
    valid = made.select("id", "tipo", "json").withColumn("error", errors(F.col("tipo"), F.col("json")))
    return found.select("id", "fecha", "subtipo", "titulo", "departamento", "url_html").join(valid, "id")


def run_day(spark: SparkSession, summary: DataFrame, documents: DataFrame, fecha: str, path: str) -> bool:
    """Writes one day; a day run again replaces its own partition only.  False for a day without candidates."""
    made = day(summary.filter(F.col("fecha") == F.lit(fecha).cast("date")), documents)
    if made.isEmpty():
        return False
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fecha").parquet(path)
    return True


def stream_days(spark: SparkSession, incoming: str, schema: str, documents: DataFrame, path: str, checkpoint: str):
    """All days that have arrived in a folder and weren't processed yet; each batch replaces the partitions of its days."""

    def sink(batch: DataFrame, _: int) -> None:
        day(batch, documents).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fecha").parquet(path)

    stream = spark.readStream.schema(schema).parquet(incoming)
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def extract_one(spark: SparkSession, tipo: str, titulo: str, texto: str, departamento: str = "") -> str | None:
    """One document's extraction; checks the request (kind, title of one character at least, text of 1 to 500,000)."""
    if tipo not in ("convocatoria", "ayuda", "licitacion") or not titulo or not 1 <= len(texto) <= 500_000:
        raise ValueError("tipo, titulo or texto out of range")
    row = spark.createDataFrame([("0", tipo, None, titulo, departamento, texto)], "id string, tipo string, subtipo string, titulo string, departamento string, texto string")
    return extract(row).first()["json"]
