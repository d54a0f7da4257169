"""The daily page: display strings, cells, rows and the page itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pliego.functions.normalize import euros
from pliego.functions.text import html_escape

#: Readable names (fixed values).
READABLE = {"oposicion": "Oposición", "concurso": "Concurso", "concurso_oposicion": "Concurso-oposición", "libre": "libre", "promocion_interna": "promoción interna", "discapacidad": "discapacidad", "otro": "otro turno"}


def readable(c: Column) -> Column:
    return F.coalesce(*[F.when(c == k, v) for k, v in READABLE.items()], c)


def term(p: Column) -> Column:
    """Days with their kind, or the end, or ""."""
    kind = F.when(p["tipo"] == "habiles", " hábiles").when(p["tipo"] == "naturales", " naturales").otherwise("")
    return F.when(p["dias"] > 0, F.concat(p["dias"].cast("string"), F.lit(" días"), kind)).when(p["fecha_fin"].isNotNull(), F.concat(F.lit("hasta el "), p["fecha_fin"].cast("string"))).otherwise("")


def posts(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda p: F.concat(p["numero"].cast("string"), F.lit(" "), readable(p["turno"]))), ", ")


def cells(tipo: str, j: Column) -> Column:
    text = lambda c: F.coalesce(c, F.lit(""))
    if tipo == "convocatoria":
        return F.array(j["organismo"], text(j["puesto"]), text(posts(j["plazas"])), text(readable(j["sistema"])), term(j["plazo_solicitudes"]))
    if tipo == "ayuda":
        return F.array(j["organismo"], text(j["objeto"]), euros(j["cuantia_total_eur"]), term(j["plazo_solicitudes"]))
    return F.array(j["organo_contratacion"], text(j["objeto"]), euros(j["valor_estimado_eur"]), text(j["fecha_limite_ofertas"].cast("string")))


def row(cell_array: Column) -> Column:
    """One escaped table row."""
    return F.concat(F.lit("<tr>"), F.array_join(F.transform(cell_array, lambda c: F.concat(F.lit("<td>"), html_escape(c), F.lit("</td>"))), ""), F.lit("</tr>"))


def markdown(metrics: DataFrame, field: str = "campo", f1: str = "f1", exact: str = "exacto") -> DataFrame:
    """One row per field with its Markdown line, three decimals."""
    return metrics.select(field, F.format_string("| %s | %.3f | %.3f |", F.col(field), F.col(f1), F.col(exact)).alias("linea"))


def page(rows: DataFrame, day: str, earlier: list[str]) -> str:
    """The page of one day: rows (tipo, fila) of a single day, and links to earlier days, newest first."""
    tables = {r["tipo"]: r["filas"] for r in rows.groupBy("tipo").agg(F.array_join(F.array_sort(F.collect_list("fila")), "\n").alias("filas")).collect()}
    links = "".join(f'<a href="{d}.html">{d}</a> ' for d in sorted(earlier, reverse=True))
    body = "".join(f"<h2>{t}</h2><table>{f}</table>" for t, f in sorted(tables.items()))
    return f"<html><head><meta charset='utf-8'><title>{day}</title></head><body><h1>{day}</h1>{body}<p>{links}</p></body></html>"
