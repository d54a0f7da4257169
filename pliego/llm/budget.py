"""Problem 2: how many tokens each document has under an existing tokenizer, and the totals by slice."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pliego.llm.spark import prepare
from pliego.llm.viterbi import counter

#: The dimensions of a slice, in order.
SLICE = ("tabla", "fuente", "idioma", "tipo", "subtipo")
#: Language of the gazette's own documents, which have no column for it.
GAZETTE_LANG = "es"


def language(col: Column) -> Column:
    """A language code as such: lower case, without region; "und" where it is missing or blank."""
    code = F.lower(F.trim(F.split(col, "[-_]")[0]))
    return F.when(code.isNull() | (code == ""), F.lit("und")).otherwise(code)


def sliced(df: DataFrame, tabla: str, key: str, text: str, fuente: Column, idioma: Column, tipo: Column, subtipo: Column, previo: Column) -> DataFrame:
    """A table in the form that the counter takes: its key as text, the slice, the old count, the text."""
    return df.select(
        F.lit(tabla).alias("tabla"), df[key].cast("string").alias("clave"), fuente.alias("fuente"), language(idioma).alias("idioma"),
        tipo.alias("tipo"), subtipo.alias("subtipo"), previo.cast("long").alias("n_previo"), df[text].alias("texto"),
    )


def token_counts(df: DataFrame, path: str) -> DataFrame:
    """Every row of a `sliced` table with `n_tok` in place of its text.

    A blank text is counted like any other: null and empty ones have 0 tokens, white space has its
    pieces.  Repeated rows come out as often as they stand there.  No shuffle.
    """
    prepare(df.sparkSession)
    names = [*SLICE, "n_previo", "clave"]

    def work(batches):
        count = counter(path)
        for batch in batches:
            n = pa.array(count.counts(batch.column(len(names)).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], n], names=[*names, "n_tok"])

    source = df.select(*names, "texto")
    return source.mapInArrow(work, T.StructType([*source.schema.fields[:-1], T.StructField("n_tok", T.LongType())]))


def token_budget(counts: DataFrame) -> DataFrame:
    """Totals of `token_counts` for each table by source, by language, by domain (tipo, subtipo) and by all of them.

    `nivel` names the grouping, in which the other dimensions are null (a null inside the grouping is
    the slice of rows without that value).  `filas` and `n_tok` count rows; `claves` and `n_tok_claves`
    count repeated rows of one key once; `con_previo` rows have a usable old count (above 0), whose
    sum is `n_previo`.  The keys are pre-aggregated, so a hot source costs no more than the others.
    """
    per_key = counts.groupBy(*SLICE, "clave").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("n_tok").alias("n_tok"), F.max("n_tok").alias("una"),
        F.count(F.when(F.col("n_previo") > 0, 1)).alias("con_previo"), F.sum(F.when(F.col("n_previo") > 0, F.col("n_previo"))).alias("n_previo"),
    )
    sums = [F.sum("filas").alias("filas"), F.sum("n_tok").alias("n_tok"), F.count(F.lit(1)).alias("claves"), F.sum("una").alias("n_tok_claves"), F.sum("con_previo").alias("con_previo"), F.coalesce(F.sum("n_previo"), F.lit(0)).alias("n_previo")]
    full = per_key.groupBy(*SLICE).agg(*sums)
    sets = {"fuente": ["fuente"], "idioma": ["idioma"], "dominio": ["tipo", "subtipo"], "todo": list(SLICE[1:])}
    rows = full.withColumn("nivel", F.explode(F.array(*map(F.lit, sets))))
    for d in SLICE[1:]:
        rows = rows.withColumn(d, F.when(F.col("nivel").isin([k for k, v in sets.items() if d in v]), F.col(d)))
    total = ["filas", "n_tok", "claves", "n_tok_claves", "con_previo", "n_previo"]
    return rows.groupBy("tabla", "nivel", *SLICE[1:]).agg(*[F.sum(t).alias(t) for t in total])
