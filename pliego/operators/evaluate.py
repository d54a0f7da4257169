"""Scores of predicted payloads against gold ones: one pass over long rows, grouping sets for all populations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pliego.functions.normalize import MONTHS
from pliego.functions.text import let, token_f1, tokens
from pliego.schemas import AMOUNTS, FREE, LISTS, LITERAL, PAYLOAD, TEXT, fields, struct


def similarity(field: str, g: Column, p: Column) -> Column:
    """Of two values that aren't null: words for text, a cent for amounts, equality for the rest."""
    if field in TEXT:
        return token_f1(g, p)
    if field in AMOUNTS:
        return (F.abs(g.cast("double") - p.cast("double")) <= 0.01).cast("double")
    return (g == p).cast("double")


def counts(field: str, g: Column, p: Column) -> Column:
    """struct(tp, fp, fn).  Lists are compared as sets."""
    if field in LISTS:
        canon = lambda c: F.array_distinct(F.transform(F.coalesce(c, F.array()), lambda x: x if field == "cpv" else F.to_json(x)))
        a, b = canon(g), canon(p)
        return F.struct(F.size(F.array_intersect(a, b)).cast("double").alias("tp"), F.size(F.array_except(b, a)).cast("double").alias("fp"), F.size(F.array_except(a, b)).cast("double").alias("fn"))
    alike = similarity(field, g, p)
    one = F.when(g.isNull() & p.isNull(), F.struct(F.lit(0.0).alias("tp"), F.lit(0.0).alias("fp"), F.lit(0.0).alias("fn")))
    one = one.when(g.isNull(), F.struct(F.lit(0.0).alias("tp"), F.lit(1.0).alias("fp"), F.lit(0.0).alias("fn"))).when(p.isNull(), F.struct(F.lit(0.0).alias("tp"), F.lit(0.0).alias("fp"), F.lit(1.0).alias("fn")))
    return one.otherwise(let({"s": alike}, lambda v: F.struct(v["s"].alias("tp"), (1 - v["s"]).alias("fp"), (1 - v["s"]).alias("fn"))))


def long_rows(df: DataFrame, pairs: dict[str, tuple[Column, Column]], keep: list[str]) -> DataFrame:
    """`keep..., campo, tp, fp, fn` for each field of each document."""
    rows = F.array(*[F.struct(F.lit(f).alias("campo"), counts(f, g, p).alias("c")) for f, (g, p) in pairs.items()])
    return df.select(*keep, F.explode(rows).alias("r")).select(*keep, "r.campo", "r.c.*")


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    """1.0 where there is nothing to find."""
    return F.when(tp + fp + fn == 0, F.lit(1.0)).otherwise(2 * tp / (2 * tp + fp + fn))


def by_field(rows: DataFrame, *groups: str) -> DataFrame:
    exact = F.avg(((F.col("fp") == 0) & (F.col("fn") == 0)).cast("double"))
    return rows.groupBy(*groups, "campo").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")], exact.alias("exacto")).withColumn("f1", f1(F.col("tp"), F.col("fp"), F.col("fn")))


def summary(fields: DataFrame) -> DataFrame:
    """micro (without free text), macro, and the free text's own F1; nulls of an empty gold set stay null."""
    free = F.col("campo").isin(*FREE)
    total = lambda c, cond: F.sum(F.when(cond, F.col(c)).otherwise(0.0))
    return fields.agg(f1(*[total(c, ~free) for c in ("tp", "fp", "fn")]).alias("micro"), F.avg(F.when(~free, F.col("f1"))).alias("macro"), f1(*[total(c, free) for c in ("tp", "fp", "fn")]).alias("texto_libre"))


def latency(df: DataFrame, ms: str, *groups: str) -> DataFrame:
    """Median, and the 95th percentile by exclusive quantiles (it goes beyond the largest value where these are few); null for fewer than two values.

    Values are counted first; the places wanted are then found by a running sum over distinct values, not rows."""
    per = df.filter(F.col(ms).isNotNull()).groupBy(*groups, F.col(ms).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("times"))
    whole = Window.partitionBy(*groups)
    per = per.withColumn("upto", F.sum("times").over(whole.orderBy("v"))).withColumn("n", F.sum("times").over(whole))
    n = F.col("n")
    j = F.least(F.greatest(F.floor(19 * (n + 1) / 20), F.lit(1)), n - 1)
    holds = lambda k: (F.col("upto") >= k) & (F.col("upto") - F.col("times") < k)
    at = lambda k: F.max(F.when(holds(k), F.col("v")))
    found = per.groupBy(*groups, "n").agg(at(F.floor((n + 1) / 2)).alias("low"), at(F.floor(n / 2) + 1).alias("high"), at(j).alias("a"), at(j + 1).alias("b"))
    d = 19 * (n + 1) - 20 * j
    p95 = F.when(n > 1, (F.col("a") * (20 - d) + F.col("b") * d) / 20)
    return found.select(*groups, "n", ((F.col("low") + F.col("high")) / 2).alias("p50"), p95.alias("p95"))


def hallucinated_literal(value: Column, text: Column) -> Column:
    """Whether less than half of the value's words stand in the text; null for a null value."""
    return uncovered(value, tokens(text))


def uncovered(value: Column, have: Column) -> Column:
    """The same with the text's words."""
    missing = lambda v: F.size(F.filter(v["words"], lambda w: F.array_contains(v["have"], w))) < F.size(v["words"]) / 2
    return F.when(value.isNotNull(), let({"words": tokens(value), "have": have}, missing))


def hallucinated_amount(value: Column, text: Column) -> Column:
    """Whether the text lacks the whole euros (with or without points) or the cents."""
    plain = F.format_string("%.2f", value)
    whole, cents = F.substring_index(plain, ".", 1), F.substring_index(plain, ".", -1)
    dotted = F.translate(F.format_number(whole.cast("decimal(30,0)"), 0), ",", ".")
    return F.when(value.isNotNull(), ~(text.contains(dotted) | text.contains(whole)) | ((cents != "00") & ~text.contains(F.concat(F.lit(","), cents))))


def hallucinated_date(value: Column, text: Column) -> Column:
    """Whether the text lacks the date in words and in figures."""
    name = F.element_at(F.array(*map(F.lit, MONTHS)), F.month(value))
    day, year = F.dayofmonth(value).cast("string"), F.year(value).cast("string")
    p = F.concat(F.lit(r"(?i)\b0?"), day, F.lit(" de "), name, F.lit(" de "), year, F.lit("|"), day, F.lit("/"), F.date_format(value, "MM"), F.lit("/"), year)
    return F.when(value.isNotNull(), ~F.regexp_like(text, p))


def flatten(tipo: str, data: Column) -> dict[str, Column]:
    """The fields of a payload by their paths; null where the payload or a parent is null."""
    return {path: data[path.split(".")[0]][path.split(".")[1]] if "." in path else data[path] for path in fields(tipo)}


def compared(path: str) -> str:
    """How two values of a field are compared: "lista", "texto", "importe" or "igual"."""
    base = path.split(".")[0]
    return "lista" if base in LISTS else "texto" if base in TEXT else "importe" if base in AMOUNTS else "igual"


def checked(path: str) -> str:
    """How a value is sought in the text: "codigos" (a list of them), "literal", "importe", "fecha", or "no"."""
    base = path.split(".")[0]
    if base == "cpv":
        return "codigos"
    return "literal" if base in LITERAL else "importe" if base in AMOUNTS else "fecha" if path.endswith("fecha_fin") or base == "fecha_limite_ofertas" else "no"


def entries(path: str, value: Column) -> Column:
    """A list's entries as texts; null for what is no list."""
    return value if path == "cpv" else F.transform(value, lambda x: F.concat_ws(":", x["turno"], x["numero"])) if path == "plazas" else F.lit(None).cast("array<string>")


def evaluation(gold: dict[str, DataFrame], predictions: DataFrame, texts: DataFrame) -> DataFrame:
    """`id, tipo, sin_prellenado, valido, campo, similitud, tp, fp, fn, alucinado`: every field of every gold record.

    gold: by kind, `id` and the payload's columns, one row per id; predictions: one row per id with json, valido and
    sin_prellenado; texts: id, texto.  A missing or invalid prediction has no values; a missing text is empty.  All
    populations are groups of these rows: one pass, whatever is asked for.  `similitud` is null where a value is missing
    and for lists; `alucinado` for what can't be sought in a text.
    """
    said = predictions.select("id", "sin_prellenado", F.coalesce("valido", F.lit(False)).alias("valido"), "json")
    out = None
    for tipo in PAYLOAD:
        known = gold[tipo].select("id", F.struct(*[f.name for f in struct(tipo).fields]).alias("g"))
        both = known.join(said, "id", "left").select("id", "sin_prellenado", F.coalesce("valido", F.lit(False)).alias("valido"), "g", F.when(F.col("valido"), F.from_json("json", struct(tipo), {"dateFormat": "yyyy-MM-dd"})).alias("p"))
        g, p = flatten(tipo, F.col("g")), flatten(tipo, F.col("p"))
        text = lambda k, c: F.lit(None).cast("string") if compared(k) == "lista" else c.cast("string")
        rows = [F.struct(F.lit(k).alias("campo"), F.lit(compared(k)).alias("como"), F.lit(checked(k)).alias("mira"), text(k, g[k]).alias("g"), text(k, p[k]).alias("p"), entries(k, g[k]).alias("gl"), entries(k, p[k]).alias("pl")) for k in g]
        one = both.select("id", F.lit(tipo).alias("tipo"), "sin_prellenado", "valido", F.explode(F.array(*rows)).alias("r")).select("id", "tipo", "sin_prellenado", "valido", "r.*")
        out = one if out is None else out.unionByName(one)
    words = texts.select("id", F.coalesce("texto", F.lit("")).alias("texto")).withColumn("palabras", tokens(F.col("texto")))
    none = F.array().cast("array<string>")
    out = out.join(words, "id", "left").withColumn("texto", F.coalesce("texto", F.lit(""))).withColumn("palabras", F.coalesce("palabras", none))
    g, p, how, look = (F.col(c) for c in ("g", "p", "como", "mira"))
    alike = F.when(how == "texto", token_f1(g, p)).when(how == "importe", (F.abs(g.cast("double") - p.cast("double")) <= 0.01).cast("double")).when(how == "igual", (g == p).cast("double"))
    out = out.withColumn("similitud", F.when(g.isNotNull() & p.isNotNull(), alike))
    s, x, y = F.col("similitud"), F.coalesce("gl", none), F.coalesce("pl", none)
    listed = how == "lista"
    number = lambda c: F.size(c).cast("double")
    tp = F.when(listed, number(F.array_intersect(x, y))).otherwise(F.coalesce(s, F.lit(0.0)))
    fp = F.when(listed, number(F.array_except(y, x))).when(p.isNull(), 0.0).when(g.isNull(), 1.0).otherwise(1 - s)
    fn = F.when(listed, number(F.array_except(x, y))).when(g.isNull(), 0.0).when(p.isNull(), 1.0).otherwise(1 - s)
    lost = F.when(look == "literal", uncovered(p, F.col("palabras"))).when(look == "importe", hallucinated_amount(p.cast("double"), F.col("texto"))).when(look == "fecha", hallucinated_date(p.try_cast("date"), F.col("texto")))
    lost = lost.when((look == "codigos") & (F.size("pl") > 0), F.size(F.array_except(F.transform("pl", F.lower), F.col("palabras"))) > 0)
    return out.select("id", "tipo", "sin_prellenado", "valido", "campo", "similitud", tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), lost.alias("alucinado"))


def populations(rows: DataFrame) -> DataFrame:
    """`poblacion, documentos, validos, alucinacion, micro, macro, texto_libre` of all records ("todo"), of each kind and of those without prefilling ("sin_prellenado"): grouping sets over one pass."""
    free = F.col("campo").isin(*FREE)
    per = rows.groupBy("tipo", "campo", F.coalesce("sin_prellenado", F.lit(False)).alias("cero")).agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn")], F.count(F.lit(1)).alias("n"), F.sum(F.col("valido").cast("int")).alias("ok"), F.sum(F.col("alucinado").cast("int")).alias("mal"), F.count("alucinado").alias("vistos"))
    named = per.withColumn("poblacion", F.explode(F.array_compact(F.array(F.lit("todo"), F.col("tipo"), F.when(F.col("cero"), "sin_prellenado")))))
    field = named.groupBy("poblacion", "tipo", "campo").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "n", "ok", "mal", "vistos")]).withColumn("f1", f1(F.col("tp"), F.col("fp"), F.col("fn")))
    total = lambda c, cond: F.sum(F.when(cond, F.col(c)).otherwise(0.0))
    first = F.col("campo").isin("organismo", "organo_contratacion")  # every record has one of them
    return field.groupBy("poblacion").agg(
        F.sum(F.when(first, F.col("n"))).alias("documentos"), (F.sum(F.when(first, F.col("ok"))) / F.sum(F.when(first, F.col("n")))).alias("validos"),
        F.coalesce(F.try_divide(F.sum("mal"), F.sum("vistos")), F.lit(0.0)).alias("alucinacion"),
        f1(*[total(c, ~free) for c in ("tp", "fp", "fn")]).alias("micro"), F.avg(F.when(~free, F.col("f1"))).alias("macro"), f1(*[total(c, free) for c in ("tp", "fp", "fn")]).alias("texto_libre"),
    )
