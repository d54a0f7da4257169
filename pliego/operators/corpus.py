"""Training corpora: prompts, chats, flat rows and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pliego.operators.sampling import is_validation


def prompt(titulo: Column, departamento: Column, texto: Column) -> Column:
    """The user's side: title, department and text; nulls are empty."""
    text = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(F.lit("Título: "), text(titulo), F.lit("\nDepartamento: "), text(departamento), F.lit("\n\n"), text(texto))


def system(tipo: Column) -> Column:
    return F.concat(F.lit("Extrae del documento de tipo "), tipo, F.lit(" los campos de su esquema y responde solo con JSON."))


def chat(tipo: Column, user: Column, answer: Column) -> Column:
    """Messages of system and user, and of the assistant where there is an answer."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    two = F.array(message("system", system(tipo)), message("user", user))
    return F.when(answer.isNull(), two).otherwise(F.concat(two, F.array(message("assistant", answer))))


def split(df: DataFrame, gold: DataFrame, key: str = "id") -> DataFrame:
    """`split` of each row: test for ids with a gold label, which goes before all else, then by the hash of the id."""
    marked = df.join(gold.select(key).distinct().withColumn("_gold", F.lit(True)), key, "left")
    return marked.withColumn("split", F.when(F.col("_gold"), "test").when(is_validation(F.col(key)), "validation").otherwise("train")).drop("_gold")
