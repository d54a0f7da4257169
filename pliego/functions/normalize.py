"""Spanish numbers, amounts, dates and deadlines out of text."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from pliego.functions.text import group, has, pattern

#: The words for 1 to 29 and for the tens, the names of the months.
UNITS = {
    "un": 1, "uno": 1, "una": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9, "diez": 10, "once": 11, "doce": 12, "trece": 13, "catorce": 14, "quince": 15, "dieciséis": 16,
    "diecisiete": 17, "dieciocho": 18, "diecinueve": 19, "veinte": 20, "veintiuno": 21, "veintidós": 22, "veintitrés": 23, "veinticuatro": 24, "veinticinco": 25, "veintiséis": 26, "veintisiete": 27, "veintiocho": 28, "veintinueve": 29,
}
TENS = {"treinta": 30, "cuarenta": 40, "cincuenta": 50, "sesenta": 60, "setenta": 70, "ochenta": 80, "noventa": 90}
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")

AMOUNT = r"(\d{1,3}(?:\.\d{3})+|\d+)(?:,(\d{1,2}))?\s*(?:de\s+)?(?:€|euros?)"
DATE = r"(\d{1,2}) de (" + "|".join(MONTHS) + r") de (\d{4})"
TERM = r"(\d+|[a-záéíóúñ]+(?: y [a-záéíóúñ]+)?) días? (hábiles|naturales)"
STATE = r"boletín oficial del estado|presente publicación"
REGIONAL = r"diario oficial|boletín oficial de (?:la|las|el) (?:comunidad|junta|región|generalitat|canarias|aragón|navarra)"


def _map(values: dict[str, int]) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in values.items()))


def number(c: Column) -> Column:
    """Digits, or a Spanish number word, as an int; "X y Y" adds a ten and a unit; null for anything else."""
    word = F.lower(F.trim(c))
    parts = F.split(word, " y ")
    return (
        F.when(word.rlike(r"^\d+$"), word.try_cast("int"))
        .when(F.size(parts) == 2, F.try_element_at(_map(TENS), parts[0]) + F.try_element_at(_map(UNITS), parts[1]))
        .otherwise(F.coalesce(F.try_element_at(_map(UNITS), word), F.try_element_at(_map(TENS), word)))
    )


def amount(c: Column) -> Column:
    """The first amount in euros as a double; null without one."""
    whole, cents = group(c, AMOUNT, 1), F.regexp_extract(c, pattern(AMOUNT), 2)
    return F.concat(F.replace(whole, F.lit("."), F.lit("")), F.lit("."), F.when(cents == "", "0").otherwise(cents)).try_cast("double")


def date(c: Column) -> Column:
    """The first "d de mes de yyyy" as a date; null without one, and for a day that doesn't exist (see `impossible_date`)."""
    month = F.try_element_at(_map({m: k for k, m in enumerate(MONTHS, 1)}), F.lower(group(c, DATE, 2)))
    text = F.format_string("%04d-%02d-%02d", group(c, DATE, 3).try_cast("int"), month, group(c, DATE, 1).try_cast("int"))
    return F.when(month.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def impossible_date(c: Column) -> Column:
    """Whether the first date in the text names a day that doesn't exist."""
    return F.coalesce(group(c, DATE, 2).isNotNull() & date(c).isNull(), F.lit(False))


def deadline(c: Column) -> Column:
    """The first "N días hábiles|naturales" as a struct dias, tipo, desde, fecha_fin (always null here); null without one.

    `desde` is read off the 250 characters after it.
    """
    kind = F.lower(group(c, TERM, 2))
    after = F.lower(F.regexp_extract(c, pattern(TERM + r"(.{0,250})", "iusUd"), 3))
    since = (
        F.when(has(after, STATE), "publicacion_boe")
        .when(after.contains("provincia"), "publicacion_boletin_provincial")
        .when(has(after, REGIONAL), "publicacion_diario_autonomico")
    )
    made = F.struct(number(group(c, TERM, 1)).alias("dias"), F.when(kind == "naturales", "naturales").otherwise("habiles").alias("tipo"), since.alias("desde"), F.lit(None).cast("date").alias("fecha_fin"))
    return F.when(kind.isNotNull(), made)


def euros(c: Column) -> Column:
    """An amount without decimals, points between thousands: "1.250.000 €"; "" for null."""
    return F.coalesce(F.concat(F.translate(F.format_number(c, 0), ",", "."), F.lit(" €")), F.lit(""))
