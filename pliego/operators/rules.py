"""Rule extraction: typed payloads out of titles and texts, as expressions."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pliego.functions.normalize import amount, date, deadline, impossible_date, number
from pliego.functions.text import first_match, group, label_line, let, section, title_case, truncate_tokens, window_after
from pliego.schemas import REQUIRED

# -- fixed values ----------------------------------------------------------------------------------------
BODY = r", (?:de|del) (?:la |el |los |las )?(.+?)(?: \([^)]*\))?, (?:por (?:la|el) que|referente)"
FILING = r"plazo (?:de|para la) presentaci[oó]n"
POSTS = r"\b([\wáéíóú]+(?: y [\wáéíóú]+)?) plazas? (?:de|del)\b"
DEGREE = r"posesi[oó]n del t[ií]tulo de ([^,.;(]+)"
FEE = r"derechos de examen|tasa (?:por|de) "
GAZETTE = r"«((?:Boletín|Diari|Diario)[^»]+)» (?:número|núm)"
BOND = {"docentes universitarios": "docente_universitario", "personal laboral": "laboral", "estatutari": "estatutario", "funcionari|escala de administración": "funcionario"}
SYSTEM = {"concurso-oposici": "concurso_oposicion", "oposici[oó]n": "oposicion", "concurso": "concurso"}
GRANT_ID = r"BDNS\s*\(Identif\.\)\s*:\s*(\d+)"
BASES = r"((?:Orden [A-Z]+/\d+/\d{4}|Real Decreto \d+/\d{4}),? de \d{1,2} de \w+)"
TOTAL = r"cuant[ií]a|presupuesto|dotaci[oó]n|importe"
MOST = r"(?:cuant[ií]a|importe) m[aá]xim[ao][^.]{0,80}?por "
REGIME = {"concurrencia competitiva": "concurrencia_competitiva", "concesi[oó]n directa": "concesion_directa"}
CONTRACT = {"entrega de los suministros": "suministros", "prestación de los servicios": "servicios", "emplazamiento principal de las obras": "obras"}
PROCEDURE = {"abierto simplificado": "abierto_simplificado", "abierto": "abierto", "restringido": "restringido", "negociado": "negociado", "diálogo competitivo": "dialogo_competitivo"}
NUTS = r"\d\.\s*Lugar[^\n]*:\n(?:[^\n]*NUTS principal:\n)?(ES\w*)"


def body(titulo: Column, departamento: Column) -> Column:
    return F.coalesce(group(titulo, BODY, 1, "uUd"), title_case(departamento))


def term(texto: Column) -> Column:
    """The deadline after the words for filing, or anywhere where these don't stand."""
    return deadline(F.coalesce(F.nullif(window_after(texto, FILING, 500), F.lit("")), texto))


def job_call(titulo: Column, departamento: Column, subtipo: Column, texto: Column) -> Column:
    start = F.left(texto, F.lit(4000))
    n = number(group(start, POSTS))
    return F.struct(
        body(titulo, departamento).alias("organismo"), F.lit(None).cast("string").alias("puesto"), first_match(start, BOND).alias("vinculo"),
        F.when(n > 0, F.array(F.struct(F.lit("libre").alias("turno"), n.alias("numero")))).otherwise(F.array().cast("array<struct<turno:string,numero:int>>")).alias("plazas"),
        first_match(start, SYSTEM).alias("sistema"), term(texto).alias("plazo_solicitudes"), F.trim(group(texto, DEGREE)).alias("titulacion"),
        amount(window_after(texto, FEE, 300)).alias("tasa_eur"), F.when(subtipo == "anuncio_local", group(start, GAZETTE, 1, "uUd")).alias("boletin_bases"),
    )


def grant(titulo: Column, departamento: Column, texto: Column) -> Column:
    end = date(window_after(texto, r"plazo de presentaci[oó]n", 400))
    only_end = F.struct(F.lit(None).cast("int").alias("dias"), F.lit(None).cast("string").alias("tipo"), F.lit(None).cast("string").alias("desde"), end.alias("fecha_fin"))
    return F.struct(
        body(titulo, departamento).alias("organismo"), section(texto, r"Objeto[^.:\n]*").alias("objeto"), section(texto, r"(?:Personas |Entidades )?Beneficiari\w*").alias("beneficiarios"),
        amount(window_after(texto, TOTAL, 600)).alias("cuantia_total_eur"), amount(window_after(texto, MOST, 200)).alias("importe_max_beneficiario_eur"),
        F.coalesce(term(texto), F.when(end.isNotNull(), only_end)).alias("plazo_solicitudes"), first_match(texto, REGIME).alias("regimen"),
        group(texto, GRANT_ID, 1, "uUd").alias("bdns_id"), group(window_after(texto, "bases reguladoras", 600), BASES, 1, "uUd").alias("bases_reguladoras"),
    )


def codes(texto: Column) -> Column:
    """CPV codes: of the main line, of the section of codes, or all that are marked so."""
    part = F.split(window_after(texto, "Códigos CPV", 3000), r"\n\d+\. ")[0]
    line = F.coalesce(F.nullif(label_line(texto, "CPV principal"), F.lit("")), part)
    first = F.array_distinct(F.regexp_extract_all(line, F.lit(r"\b(\d{8})\b"), F.lit(1)))
    return F.when(F.size(first) > 0, first).otherwise(F.regexp_extract_all(texto, F.lit(r"CPV: (\d{8})"), F.lit(1)))


def lots(texto: Column) -> Column:
    return F.array_max(F.transform(F.regexp_extract_all(texto, F.lit(r"Lote (\d+):"), F.lit(1)), lambda x: x.try_cast("int")))


def tender(titulo: Column, departamento: Column, texto: Column) -> Column:
    proc = F.lower(F.coalesce(label_line(texto, "Tipo de procedimiento"), F.lit("")))
    kind = F.coalesce(*[F.when(proc.startswith(k), v) for k, v in PROCEDURE.items()], F.when(proc != "", "otro"))
    return F.struct(
        F.coalesce(F.nullif(label_line(texto, r"1\.1\) Nombre"), F.lit("")), title_case(departamento)).alias("organo_contratacion"), F.coalesce(F.nullif(label_line(texto, "Descripción de la licitación"), F.lit("")), titulo).alias("objeto"),
        first_match(texto, CONTRACT).alias("tipo_contrato"), kind.alias("procedimiento"), amount(label_line(texto, "Valor estimado")).alias("valor_estimado_eur"), F.lit(None).cast("double").alias("presupuesto_base_eur"),
        date(label_line(texto, "Plazo para la recepción de ofertas")).alias("fecha_limite_ofertas"), group(texto, NUTS, 1, "uUd").alias("lugar_ejecucion_nuts"), codes(texto).alias("cpv"),
        group(label_line(texto, "Duración del contrato"), r"(\d+) meses").try_cast("int").alias("duracion_meses"), lots(texto).alias("lotes"),
    )


#: Tokens of a text that rules see (fixed value).
MOST_TOKENS = 6144


def extract(df: DataFrame, most: int = MOST_TOKENS) -> DataFrame:
    """`id, tipo, json, valido` of documents of the three kinds, with every field, read from the first `most` tokens of the text; a null text counts as empty.

    Rows of another kind have a null json and aren't valid.  A record is valid if its payload is one of its kind's
    schema and no date that a rule read names a day that doesn't exist.
    """
    df = df.withColumn("texto", truncate_tokens(F.coalesce(df.texto, F.lit("")), most))
    text = F.col("texto")
    made = {"convocatoria": job_call(F.col("titulo"), F.col("departamento"), F.col("subtipo"), text), "ayuda": grant(F.col("titulo"), F.col("departamento"), text), "licitacion": tender(F.col("titulo"), F.col("departamento"), text)}
    read = {"ayuda": window_after(text, r"plazo de presentaci[oó]n", 400), "licitacion": label_line(text, "Plazo para la recepción de ofertas")}
    keep = {"ignoreNullFields": "false"}
    wrong = F.coalesce(*[F.when(F.col("tipo") == k, let({"t": v}, lambda x: impossible_date(x["t"]))) for k, v in read.items()], F.lit(False))
    out = df.select("id", "tipo", F.coalesce(*[F.when(F.col("tipo") == k, F.to_json(v, keep)) for k, v in made.items()]).alias("json"), wrong.alias("_wrong"))
    # types, vocabularies and field names hold by the making; what may be missing is a required field
    there = [(F.col("tipo") == k) & reduce(and_, [F.get_json_object("json", f"$.{r}").isNotNull() for r in REQUIRED[k]]) for k in made]
    return out.select("id", "tipo", "json", F.coalesce(reduce(or_, there) & ~F.col("_wrong"), F.lit(False)).alias("valido"))
