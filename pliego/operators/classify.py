"""Classification of gazette items by section and title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# -- fixed values: what titles must and mustn't contain (in lower case) --------------------------------
NOT_ORIGINAL = r"corrección de errores|se corrigen errores|deja sin efecto|rectifica"
CALLS = r"por (?:la|el) que se convoca|referente a la convocatoria"
CALL_NOT = r"se modifica|se publica|relación|aspirantes|aprobad|admitid|excluid|tribunal|se resuelve"
FREE_EPIGRAPH, FREE = "Procedimientos de libre designación", "libre designación"
LOCAL = r"ayuntamiento|diputació|consell (?:comarcal|insular)|cabildo|comarca|mancomunidad|referente a la convocatoria"
GRANT_5B_NOT = r"se modifica|modificación del extracto|se amplía|ampliar el|acuerda la ampliación"
GRANT_3, GRANT_3_NOT = r"ayuda|subvenci|premio|beca", r"se modifica|convenio|jurado|se publica|se autoriza|se establecen"
TENDER = "anuncio de licitación"


def tipo(titulo: Column, seccion: Column, epigrafe: Column) -> Column:
    """convocatoria, ayuda, licitacion or null.  A null epigraph of section 2B is no convocatoria."""
    t = F.lower(titulo)
    call = (seccion == "2B") & t.rlike(CALLS) & ~t.rlike(CALL_NOT) & (epigrafe != FREE_EPIGRAPH) & ~t.contains(FREE)
    grant = ((seccion == "5B") & t.startswith("extracto") & t.contains("convoca") & ~t.rlike(GRANT_5B_NOT)) | ((seccion == "3") & t.contains("convoca") & t.rlike(GRANT_3) & ~t.rlike(GRANT_3_NOT))
    return F.when(t.rlike(NOT_ORIGINAL), None).when(call, "convocatoria").when(grant, "ayuda").when((seccion == "5A") & t.startswith(TENDER), "licitacion")


def subtipo(kind: Column, titulo: Column) -> Column:
    """anuncio_local or bases for a convocatoria, else null."""
    return F.when(kind == "convocatoria", F.when(F.lower(titulo).rlike(LOCAL), "anuncio_local").otherwise("bases"))


def classify(df: DataFrame) -> DataFrame:
    """The summary with tipo and subtipo, candidates only.  The sections come first, which the scan can prune by."""
    kind = tipo(df.titulo, df.seccion, df.epigrafe)
    return df.filter(df.seccion.isin("2B", "3", "5A", "5B")).withColumn("tipo", kind).filter("tipo IS NOT NULL").withColumn("subtipo", subtipo(F.col("tipo"), F.col("titulo")))
