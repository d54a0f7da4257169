"""Labelling conventions, the same for machine and human labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pliego.functions.normalize import MONTHS
from pliego.functions.text import has, pattern, window_after

# -- fixed values ----------------------------------------------------------------------------------------
ACCESS = r"acceso|ingreso|pruebas selectivas|oposici|estabilizaci"
POST_TITLE = r"provisi[oó]n de(l)? puestos?|concurso (espec[ií]fico|general|de m[eé]ritos|de traslados|ordinario)|provisi[oó]n de (destinos|vacantes)|para (la )?provisi[oó]n|se convoca vacante|para proveer puestos?"
POST_TEXT = r"proveer,? (mediante|por) (el sistema de )?concurso|libre designaci|turno de movilidad|provisi[oó]n (del|de) puesto|concurso de m[eé]ritos"
FREE_TURN = r"turno libre|acceso libre"
FILING = r"plazo (?:de|para la) presentaci[oó]n"
FIXED_START = r"(inici|comienz|comenz|abr|desde|entre|a partir)[^.]{0,40}?\b\d{1,2} de [a-z]+"
REGIME = r"concurrencia|(concesi[oó]n|adjudicaci[oó]n) directa"
NORM, CITATION = r"^(?:Orden|Real Decreto|Resolución|Decreto|Ley|Acuerdo)\b", r"^(.*?\b\d{1,2} de [a-záéíóú]+(?: de \d{4})?)"
POST_NAME = r"^[\wáéíóú]+ (?:plazas?|puestos?) de ([^,.]+?)(?:,| pertenecientes?| por el)"


def is_provision(titulo: Column, texto: Column) -> Column:
    """Whether a call fills posts among officials instead of giving access."""
    return F.when(has(titulo, ACCESS), False).otherwise(has(titulo, POST_TITLE) | (has(texto, POST_TEXT) & ~has(texto, FREE_TURN)))


def term_month(term: Column, texto: Column) -> Column:
    """A term of "un mes" is 30 natural days."""
    month = has(window_after(texto, FILING, 400), r"\bun mes\b") & F.coalesce(term["dias"] == 1, F.lit(True)) & term["fecha_fin"].isNull()
    return F.when(term.isNotNull() & month, term.withField("dias", F.lit(30)).withField("tipo", F.lit("naturales"))).otherwise(term)


def term_start(term: Column, texto: Column) -> Column:
    """Where a term with nothing but its end starts, by the 300 characters before that date."""
    end, low = term["fecha_fin"], F.lower(texto)
    name = F.concat(F.dayofmonth(end), F.lit(" de "), F.element_at(F.array(*map(F.lit, MONTHS)), F.month(end)))
    full, short = (F.regexp_instr(low, F.concat(F.lit(r"\b0?"), x)) for x in (F.concat(name, F.lit(" de "), F.year(end)), name))
    at = F.when(full > 0, full).otherwise(short)
    before = F.when(at > 0, F.substring(texto, F.greatest(at - 300, F.lit(1)), F.least(at - 1, F.lit(300)))).otherwise("")
    since = F.when(has(before, FIXED_START), "otro").when(F.lower(before).contains("publicaci"), "publicacion_boe")
    return F.when(end.isNotNull() & term["dias"].isNull(), term.withField("desde", since)).otherwise(term)


def sum_turns(posts: Column) -> Column:
    """One entry per turn, in order of first appearance."""
    turns = F.array_distinct(F.transform(posts, lambda p: p["turno"]))
    total = lambda t: F.aggregate(F.filter(posts, lambda p: p["turno"] == t), F.lit(0), lambda acc, p: acc + p["numero"])
    return F.transform(turns, lambda t: F.struct(t.alias("turno"), total(t).alias("numero")))


def free_to_other(posts: Column) -> Column:
    return F.transform(posts, lambda p: p.withField("turno", F.when(p["turno"] == "libre", "otro").otherwise(p["turno"])))


def regime(value: Column, texto: Column) -> Column:
    return F.when(has(texto, REGIME), value)


def citation(value: Column) -> Column:
    """A legal norm up to its date, anything else as it is."""
    short = F.regexp_extract(value, pattern(CITATION), 1)
    return F.when(value.rlike(pattern(NORM, "uUd")) & (short != ""), short).otherwise(value)


def many_posts(texto: Column) -> Column:
    """How many different posts the first 3000 characters name."""
    names = F.regexp_extract_all(F.left(texto, F.lit(3000)), F.lit(pattern(POST_NAME, "imuUd")), F.lit(1))
    return F.size(F.array_distinct(F.transform(names, lambda n: F.lower(F.trim(n)))))


def align(tipo: str, data: Column, titulo: Column, texto: Column) -> Column:
    """A payload under all conventions; tenders pass through."""
    if tipo in ("ayuda", "convocatoria"):
        data = data.withField("plazo_solicitudes", term_start(term_month(data["plazo_solicitudes"], texto), texto))
    if tipo == "ayuda":
        data = data.withField("regimen", regime(data["regimen"], texto)).withField("bases_reguladoras", citation(data["bases_reguladoras"]))
    if tipo == "convocatoria":
        posts = F.when(is_provision(titulo, texto), free_to_other(data["plazas"])).otherwise(data["plazas"])
        data = data.withField("plazas", sum_turns(posts)).withField("puesto", F.when(many_posts(texto) <= 1, data["puesto"]))
    return data
