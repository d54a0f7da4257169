"""Summary and document XML into rows."""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pliego.functions.text import try_int
from pliego.plans.session import ship

S = T.StringType()
_PDF = T.StructType([T.StructField(n, S) for n in ("_VALUE", "_szKBytes", "_pagina_inicial", "_pagina_final")])
_ITEM = T.ArrayType(T.StructType([T.StructField("identificador", S), T.StructField("titulo", S), T.StructField("url_pdf", _PDF), T.StructField("url_html", S), T.StructField("url_xml", S)]))
_EPIGRAPH = T.ArrayType(T.StructType([T.StructField("_nombre", S), T.StructField("item", _ITEM)]))
_DEPARTMENT = T.ArrayType(T.StructType([T.StructField("_codigo", S), T.StructField("_nombre", S), T.StructField("epigrafe", _EPIGRAPH), T.StructField("item", _ITEM)]))
_SECTION = T.ArrayType(T.StructType([T.StructField("_codigo", S), T.StructField("_nombre", S), T.StructField("departamento", _DEPARTMENT)]))
_ISSUE = T.ArrayType(T.StructType([T.StructField("_numero", S), T.StructField("seccion", _SECTION)]))
SUMMARY_XML = T.StructType([T.StructField("metadatos", T.StructType([T.StructField("fecha_publicacion", S)])), T.StructField("diario", _ISSUE)])
#: The section of appointments, which isn't kept (fixed value).
EXCLUDED = "2A"


def flatten_summary(df: DataFrame, xml: str) -> DataFrame:
    """One row per item of each summary (`xml` holds its <sumario> element): items of epigraphs before a department's own,
    section 2A left out, a section without code kept; figures that aren't all digits are null."""
    empty = F.array().cast(_ITEM)
    top = df.select(F.from_xml(F.col(xml), SUMMARY_XML, {"rowTag": "sumario"}).alias("s")).select(F.to_date("s.metadatos.fecha_publicacion", "yyyyMMdd").alias("fecha"), F.explode("s.diario").alias("d"))
    sections = top.select("fecha", F.col("d._numero").alias("numero"), F.explode("d.seccion").alias("sec")).filter(F.coalesce(F.col("sec._codigo") != EXCLUDED, F.lit(True)))
    deps = sections.select("fecha", "numero", "sec._codigo", "sec._nombre", F.explode("sec.departamento").alias("dep")).toDF("fecha", "numero", "codigo", "nombre", "dep")
    groups = F.concat(
        F.transform(F.coalesce(F.col("dep.epigrafe"), F.array().cast(_EPIGRAPH)), lambda e: F.struct(e["_nombre"].alias("epigrafe"), F.coalesce(e["item"], empty).alias("items"))),
        F.array(F.struct(F.lit(None).cast("string").alias("epigrafe"), F.coalesce(F.col("dep.item"), empty).alias("items"))),
    )
    items = deps.select("*", F.explode(groups).alias("g")).select("*", F.explode("g.items").alias("i"))
    pdf = F.col("i.url_pdf")
    return items.select(
        F.col("i.identificador").alias("id"), "fecha", try_int(F.col("numero")).alias("diario_numero"), F.col("codigo").alias("seccion"), F.col("nombre").alias("seccion_nombre"), F.col("dep._codigo").alias("departamento_codigo"),
        F.col("dep._nombre").alias("departamento"), F.col("g.epigrafe").alias("epigrafe"), F.col("i.titulo").alias("titulo"), try_int(pdf["_pagina_inicial"]).alias("pagina_inicial"), try_int(pdf["_pagina_final"]).alias("pagina_final"),
        try_int(pdf["_szKBytes"]).alias("pdf_kb"), pdf["_VALUE"].alias("url_pdf"), F.col("i.url_html").alias("url_html"), F.col("i.url_xml").alias("url_xml"),
    )


#: Elements that are lines of their own (fixed value).
BLOCKS = {"p", "dt", "dd", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6"}


def _squeeze(el: ET.Element) -> str:
    return " ".join("".join(el.itertext()).split())


def _lines(el: ET.Element):
    for child in el:
        if child.tag == "tr":
            yield " | ".join(_squeeze(cell) for cell in child)
        elif child.tag in BLOCKS and not any(x.tag in BLOCKS for x in child.iter() if x is not child):
            yield _squeeze(child)
        else:
            yield from _lines(child)


def document_fields(xml: str | None) -> tuple[str | None, str | None, str | None]:
    """Rank, analysis (JSON: leaf tag -> texts) and text of one document; nulls for what isn't XML."""
    try:
        root = ET.fromstring(xml)
    except (ET.ParseError, TypeError):
        return None, None, None
    leaves: dict[str, list[str]] = {}
    analysis, text = root.find("analisis"), root.find("texto")
    for el in analysis.iter() if analysis is not None else ():
        if len(el) == 0 and (value := _squeeze(el)):
            leaves.setdefault(el.tag, []).append(value)
    lines = "" if text is None else "\n".join(line for line in _lines(text) if line)
    return root.findtext("metadatos/rango"), json.dumps(leaves, ensure_ascii=False), lines


def parse_documents(df: DataFrame, key: str, xml: str) -> DataFrame:
    """`key, rango, analisis, texto` of document XML (mixed content in order, which JVM-side readers don't keep)."""
    ship(df.sparkSession)

    def work(batches):
        for batch in batches:
            parts = [document_fields(x) for x in batch.column(1).to_pylist()]
            cols = list(zip(*parts)) if parts else [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.string()) for c in cols]], names=[key, "rango", "analisis", "texto"])

    return df.select(key, xml).mapInArrow(work, f"{key} {df.schema[key].dataType.simpleString()}, rango string, analisis string, texto string")


def days(first: Column, last: Column) -> Column:
    """Every day between two yyyyMMdd dates, both included, none after today."""
    return F.filter(F.sequence(F.to_date(first, "yyyyMMdd"), F.to_date(last, "yyyyMMdd")), lambda d: d <= F.current_date())
