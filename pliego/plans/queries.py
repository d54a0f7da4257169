"""One query per operator over the gazette tables, each with the SQL that says the same."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pliego.functions import normalize as N
from pliego.functions import text as X
from pliego.operators import classify as C
from pliego.operators import conventions as V
from pliego.operators import corpus, report, rules, sampling
from pliego.operators import evaluate as E
from pliego.operators.validate import errors
from pliego.schemas import LITERAL, PAYLOAD, fields, kinds, struct
from pliego.sources.records import read_records, write_day, write_records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# -- SQL pieces --------------------------------------------------------------------------------------


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(c: str, p: str, g: int = 1, i: bool = True) -> str:
    return f"nullif(regexp_extract({c}, {lit(('(?i)' if i else '') + p)}, {g}), '')"


def after(c: str, p: str, n: int) -> str:
    return f"regexp_extract({c}, {lit(f'(?is)(?:{p})(.{{0,{n}}})')}, 1)"


def match(c: str, p: str, i: bool = True) -> str:
    return f"regexp_matches({c}, {lit(('(?i)' if i else '') + p)})"


def words_sql(c: str) -> str:
    folded = f"strip_accents(lower({c}))"
    for a, b in (("º", "o"), ("ª", "a"), ("ß", "ss"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("½", "1⁄2"), ("²", "2"), ("³", "3"), ("№", "no"), ("™", "tm")):  # written out, not taken from the engine
        folded = f"replace({folded}, '{a}', '{b}')"
    return f"regexp_extract_all({folded}, '[\\p{{L}}\\p{{N}}_]+')"


def f1_sql(a: str, b: str) -> str:
    """Word overlap of two columns of word lists."""
    common = f"coalesce(list_sum(list_transform(list_distinct({a}), lambda w: least(len(list_filter({a}, lambda t: t = w)), len(list_filter({b}, lambda t: t = w))))), 0)"
    return f"CASE WHEN {common} = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * {common} / (len({a}) + len({b})) END"


def number_sql(c: str) -> str:
    one = lambda e, m: f"CASE {e} " + " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in m.items()) + " END"
    w = f"lower(trim({c}))"
    return f"CASE WHEN regexp_full_match({w}, '[0-9]+') THEN try_cast({w} AS INTEGER) WHEN len(string_split({w}, ' y ')) = 2 THEN {one(f'split_part({w}, {lit(' y ')}, 1)', N.TENS)} + {one(f'split_part({w}, {lit(' y ')}, 2)', N.UNITS)} ELSE coalesce({one(w, N.UNITS)}, {one(w, N.TENS)}) END"


def amount_sql(c: str) -> str:
    return f"try_cast(replace({rx(c, N.AMOUNT, 1)}, '.', '') || '.' || coalesce({rx(c, N.AMOUNT, 2)}, '0') AS DOUBLE)"


def month_sql(c: str) -> str:
    return f"list_position([{', '.join(map(lit, N.MONTHS))}], lower({c}))"


def date_sql(c: str) -> str:
    return f"try_cast({rx(c, N.DATE, 3)} || '-' || lpad({month_sql(rx(c, N.DATE, 2))}::VARCHAR, 2, '0') || '-' || lpad({rx(c, N.DATE, 1)}, 2, '0') AS DATE)"


def title_sql(c: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all({c}, '\\p{{L}}+|[^\\p{{L}}]+'), lambda w: upper(w[1]) || lower(w[2:])), '')"


def docs(spark: SparkSession, d: str) -> DataFrame:
    """The documents' rows; repeated rows of an id hold the same text.  Queries extract first and then drop repeated
    outcomes, so that no text is shuffled."""
    return spread(table(spark, d, "boe_documents"))


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer partitions than there are cores, dealt out to all of them, since extraction is work for the processor; larger ones stay as they are read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


DOCS_SQL = "SELECT id, max(tipo) AS tipo, max(subtipo) AS subtipo, max(titulo) AS titulo, max(departamento) AS departamento, max(texto) AS texto FROM boe_documents GROUP BY id"


def over_docs(select: str, where: str = "") -> str:
    return f"WITH d AS ({DOCS_SQL}) SELECT {select} FROM d {where}"


# -- scans, filters, joins ------------------------------------------------------------------------------


@query("SELECT id, fecha, seccion, titulo FROM boe_sumario WHERE fecha >= DATE '2026-08-01'")
def scan_parquet(spark, d):
    return table(spark, d, "boe_sumario").filter(F.col("fecha") >= F.lit("2026-08-01").cast("date")).select("id", "fecha", "seccion", "titulo")


@query("SELECT id, titulo FROM boe_sumario WHERE titulo LIKE 'Anuncio%'")
def filter_prefix(spark, d):
    return table(spark, d, "boe_sumario").filter(F.col("titulo").startswith("Anuncio")).select("id", "titulo")


@query(f"SELECT id, titulo FROM boe_sumario WHERE regexp_matches(lower(titulo), {lit(C.CALLS)})")
def filter_rlike(spark, d):
    return table(spark, d, "boe_sumario").filter(F.lower("titulo").rlike(C.CALLS)).select("id", "titulo")


@query("SELECT id, strftime(fecha, '%Y-%m-%d') AS fecha, tipo, subtipo, titulo, departamento FROM boe_documents")
def project_output(spark, d):
    return table(spark, d, "boe_documents").select("id", F.date_format("fecha", "yyyy-MM-dd").alias("fecha"), "tipo", "subtipo", "titulo", "departamento")


@query("SELECT s.id, s.titulo FROM boe_sumario s SEMI JOIN hf h ON s.id = h.id")
def semi_join_ids(spark, d):
    return table(spark, d, "boe_sumario").join(table(spark, d, "hf").select("id"), "id", "left_semi").select("id", "titulo")


@query("SELECT DISTINCT id, tipo FROM boe_documents b WHERE NOT EXISTS (SELECT 1 FROM etiquetas e WHERE e.id = b.id)")
def anti_join_pending(spark, d):
    return sampling.pending(table(spark, d, "boe_documents").select("id", "tipo").distinct(), table(spark, d, "etiquetas"))


@query("SELECT s.id, s.departamento_codigo, a.nombre FROM boe_sumario s JOIN departamentos a ON s.departamento_codigo = a.codigo")
def lookup_map(spark, d):
    areas = table(spark, d, "departamentos").select(F.col("codigo").alias("departamento_codigo"), "nombre")
    return table(spark, d, "boe_sumario").join(areas, "departamento_codigo").select("id", "departamento_codigo", "nombre")


@query("SELECT s.id, s.seccion, b.tipo, b.n_tokens FROM boe_sumario s JOIN boe_documents b ON s.id = b.id")
def join_inner(spark, d):
    return table(spark, d, "boe_sumario").select("id", "seccion").join(table(spark, d, "boe_documents").select("id", "tipo", "n_tokens"), "id")


@query("SELECT h.row_id, h.id, coalesce(max(length(b.texto)), 0)::BIGINT AS n FROM hf h LEFT JOIN boe_documents b ON h.id = b.id GROUP BY h.row_id, h.id")
def join_left_eval(spark, d):
    texts = docs(spark, d).select("id", F.length("texto").alias("n")).distinct()
    return table(spark, d, "hf").select("row_id", "id").join(texts, "id", "left").select("row_id", "id", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("SELECT CASE WHEN fecha < DATE '2026-08-01' THEN 'train' ELSE 'gold' END AS periodo, count(*) AS n FROM boe_documents GROUP BY 1")
def period_split(spark, d):
    return table(spark, d, "boe_documents").groupBy(F.when(F.col("fecha") < F.lit("2026-08-01").cast("date"), "train").otherwise("gold").alias("periodo")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT coalesce(subtipo, tipo) AS grupo, count(*) AS n FROM boe_documents GROUP BY 1")
def coalesce_group(spark, d):
    return table(spark, d, "boe_documents").groupBy(F.coalesce("subtipo", "tipo").alias("grupo")).agg(F.count(F.lit(1)).alias("n"))


# -- classification ----------------------------------------------------------------------------------------

_t = "lower(titulo)"
TYPE_SQL = (
    f"CASE WHEN regexp_matches({_t}, {lit(C.NOT_ORIGINAL)}) THEN NULL "
    f"WHEN seccion = '2B' AND regexp_matches({_t}, {lit(C.CALLS)}) AND NOT regexp_matches({_t}, {lit(C.CALL_NOT)}) AND epigrafe <> {lit(C.FREE_EPIGRAPH)} AND NOT contains({_t}, {lit(C.FREE)}) THEN 'convocatoria' "
    f"WHEN (seccion = '5B' AND starts_with({_t}, 'extracto') AND contains({_t}, 'convoca') AND NOT regexp_matches({_t}, {lit(C.GRANT_5B_NOT)})) OR (seccion = '3' AND contains({_t}, 'convoca') AND regexp_matches({_t}, {lit(C.GRANT_3)}) AND NOT regexp_matches({_t}, {lit(C.GRANT_3_NOT)})) THEN 'ayuda' "
    f"WHEN seccion = '5A' AND starts_with({_t}, {lit(C.TENDER)}) THEN 'licitacion' END"
)
SUBTYPE_SQL = f"CASE WHEN tipo = 'convocatoria' THEN CASE WHEN regexp_matches({_t}, {lit(C.LOCAL)}) THEN 'anuncio_local' ELSE 'bases' END END"


@query(f"SELECT id, {TYPE_SQL} AS tipo FROM boe_sumario")
def classify_type(spark, d):
    s = table(spark, d, "boe_sumario")
    return s.select("id", C.tipo(s.titulo, s.seccion, s.epigrafe).alias("tipo"))


@query(f"WITH c AS (SELECT id, titulo, {TYPE_SQL} AS tipo FROM boe_sumario) SELECT id, tipo, {SUBTYPE_SQL} AS subtipo FROM c")
def classify_subtype(spark, d):
    s = table(spark, d, "boe_sumario")
    return s.select("id", "titulo", C.tipo(s.titulo, s.seccion, s.epigrafe).alias("tipo")).select("id", "tipo", C.subtipo(F.col("tipo"), F.col("titulo")).alias("subtipo"))


@query(f"WITH c AS (SELECT *, {TYPE_SQL} AS tipo FROM boe_sumario) SELECT id, fecha, seccion, titulo, tipo, {SUBTYPE_SQL} AS subtipo FROM c WHERE tipo IS NOT NULL")
def classify_candidates(spark, d):
    return C.classify(table(spark, d, "boe_sumario")).select("id", "fecha", "seccion", "titulo", "tipo", "subtipo")


@query(f"WITH c AS (SELECT *, {TYPE_SQL} AS tipo FROM boe_sumario), k AS (SELECT tipo, {SUBTYPE_SQL} AS subtipo FROM c WHERE tipo IS NOT NULL) SELECT tipo, subtipo, count(*) AS n FROM k GROUP BY tipo, subtipo")
def agg_count_by_type(spark, d):
    return C.classify(table(spark, d, "boe_sumario")).groupBy("tipo", "subtipo").agg(F.count(F.lit(1)).alias("n"))


# -- aggregates, windows, samples --------------------------------------------------------------------------


@query("SELECT tipo, subtipo, count(n_tokens) AS n, median(n_tokens)::DOUBLE AS mediana, quantile_disc(n_tokens, 0.95)::DOUBLE AS p95, max(n_tokens) AS maximo, round(avg(CASE WHEN n_tokens > 4096 THEN 1.0 WHEN n_tokens IS NOT NULL THEN 0.0 END), 3) AS largo FROM boe_documents GROUP BY tipo, subtipo")
def token_stats(spark, d):
    n = F.col("n_tokens")
    return table(spark, d, "boe_documents").groupBy("tipo", "subtipo").agg(
        F.count(n).alias("n"), F.median(n).alias("mediana"), F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY n_tokens)").alias("p95"), F.max(n).alias("maximo"), F.round(F.avg((n > 4096).cast("int")), 3).alias("largo"))


@query("SELECT id, max_by(fuente, struct_pack(ts, fuente, tokens_out, latencia_ms)) AS fuente, max(ts) AS ts FROM etiquetas GROUP BY id")
def latest_by_id(spark, d):
    return sampling.latest(table(spark, d, "etiquetas").select("id", "fuente", "ts", "tokens_out", "latencia_ms"), "id", "ts", "fuente", "tokens_out", "latencia_ms").select("id", "fuente", "ts")


QUOTAS = {"bases": None, "ayuda": None, "licitacion": 60, "anuncio_local": 40}
UNIQUE_GROUPS = "SELECT id, max(coalesce(subtipo, tipo)) AS grupo FROM boe_documents GROUP BY id"


@query(f"WITH u AS ({UNIQUE_GROUPS}), r AS (SELECT *, row_number() OVER (PARTITION BY grupo ORDER BY md5('42:' || id), id) AS r FROM u) SELECT id, grupo FROM r WHERE grupo IN ('bases', 'ayuda') OR (grupo = 'licitacion' AND r <= 60) OR (grupo = 'anuncio_local' AND r <= 40)")
def stratified_sample(spark, d):
    u = table(spark, d, "boe_documents").groupBy("id").agg(F.max(F.coalesce("subtipo", "tipo")).alias("grupo"))
    return sampling.stratified(u, "grupo", QUOTAS).select("id", "grupo")


@query("WITH u AS (SELECT id, max(tipo) AS tipo FROM boe_documents GROUP BY id) SELECT id, tipo, row_number() OVER (PARTITION BY tipo ORDER BY md5('42:' || id), id) <= 10 AS sin_prellenado FROM u")
def window_flag_k_per_group(spark, d):
    u = table(spark, d, "boe_documents").groupBy("id").agg(F.max("tipo").alias("tipo"))
    return sampling.flag_k(u, "tipo", 10, "sin_prellenado")


@query("SELECT id, sin_prellenado, ts FROM (SELECT DISTINCT id, sin_prellenado, ts FROM etiquetas) ORDER BY sin_prellenado DESC, ts, id LIMIT 50")
def topk_priority(spark, d):
    return table(spark, d, "etiquetas").select("id", "sin_prellenado", "ts").distinct().orderBy(F.desc("sin_prellenado"), "ts", "id").limit(50)


@query("SELECT 'convocatoria' AS tabla, id, organismo AS nombre FROM convocatoria UNION ALL SELECT 'ayuda', id, organismo FROM ayuda UNION ALL SELECT 'licitacion', id, organo_contratacion FROM licitacion")
def union_groups(spark, d):
    one = lambda t, c: table(spark, d, t).select(F.lit(t).alias("tabla"), "id", F.col(c).alias("nombre"))
    return one("convocatoria", "organismo").unionByName(one("ayuda", "organismo")).unionByName(one("licitacion", "organo_contratacion"))


@query("WITH r AS (SELECT min(fecha) AS a, max(fecha) AS b FROM boe_sumario), g AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS dia FROM r) SELECT strftime(dia, '%Y%m%d') AS dia, count(s.id) AS n FROM g LEFT JOIN boe_sumario s ON s.fecha = g.dia GROUP BY 1")
def date_range(spark, d):
    s = table(spark, d, "boe_sumario")
    every = s.agg(F.min("fecha").alias("a"), F.max("fecha").alias("b")).select(F.explode(F.sequence("a", "b")).alias("fecha"))
    return every.join(s.groupBy("fecha").agg(F.count("id").alias("n")), "fecha", "left").select(F.date_format("fecha", "yyyyMMdd").alias("dia"), F.coalesce("n", F.lit(0)).alias("n"))


_word = lambda k: f"('0x' || substr(md5(id), {1 + 8 * k}, 8))::BIGINT"
SPLIT_SQL = f"(((({_word(0)} % 1000) * 296 + {_word(1)}) % 1000 * 296 + {_word(2)}) % 1000 * 296 + {_word(3)}) % 1000 < 50"


@query(f"SELECT DISTINCT id, {SPLIT_SQL} AS es_val FROM boe_documents")
def hash_split(spark, d):
    return table(spark, d, "boe_documents").select("id").distinct().select("id", sampling.is_validation(F.col("id")).alias("es_val"))


@query(f"WITH u AS (SELECT DISTINCT id, tipo FROM boe_documents), s AS (SELECT tipo, CASE WHEN id IN (SELECT id FROM etiquetas WHERE fuente = 'gold_pre') THEN 'test' WHEN {SPLIT_SQL} THEN 'validation' ELSE 'train' END AS split FROM u) SELECT split, tipo, count(*) AS n FROM s GROUP BY split, tipo")
def corpus_split_counts(spark, d):
    gold = table(spark, d, "etiquetas").filter(F.col("fuente") == "gold_pre")
    return corpus.split(table(spark, d, "boe_documents").select("id", "tipo").distinct(), gold).groupBy("split", "tipo").agg(F.count(F.lit(1)).alias("n"))


@query(over_docs("id, tipo, subtipo, titulo, departamento, length(texto)::INTEGER AS largo"))
def corpus_rows(spark, d):
    return docs(spark, d).select("id", "tipo", "subtipo", "titulo", "departamento", F.length("texto").alias("largo")).distinct()


@query(over_docs("id, md5('Título: ' || coalesce(titulo, '') || chr(10) || 'Departamento: ' || coalesce(departamento, '') || chr(10) || chr(10) || coalesce(texto, '')) AS huella"))
def prompt_user(spark, d):
    x = docs(spark, d)
    return x.select("id", F.md5(corpus.prompt(x.titulo, x.departamento, x.texto)).alias("huella")).distinct()


@query("SELECT row_id, CASE WHEN json IS NULL THEN 2 ELSE 3 END::INTEGER AS mensajes, CASE WHEN json IS NULL THEN 'user' ELSE 'assistant' END AS ultimo FROM hf")
def chat_assemble(spark, d):
    h = table(spark, d, "hf")
    m = corpus.chat(h.tipo, corpus.prompt(h.titulo, h.departamento, h.texto), h.json)
    return h.select("row_id", F.size(m).alias("mensajes"), F.element_at(m, -1)["role"].alias("ultimo"))


@query("SELECT fuente, avg(CASE WHEN valido THEN 1.0 ELSE 0.0 END)::DOUBLE AS validos FROM etiquetas GROUP BY fuente")
def valid_rate(spark, d):
    return table(spark, d, "etiquetas").groupBy("fuente").agg(F.avg(F.coalesce("valido", F.lit(False)).cast("double")).alias("validos"))


@query(
    "WITH l AS (SELECT fuente, list_sort(list(latencia_ms::DOUBLE)) AS v FROM etiquetas WHERE latencia_ms IS NOT NULL GROUP BY fuente), j AS (SELECT fuente, v, len(v) AS n, least(greatest((19 * (len(v) + 1)) // 20, 1), len(v) - 1) AS j FROM l) "
    "SELECT fuente, n, (v[(n + 1) // 2] + v[n // 2 + 1]) / 2 AS p50, CASE WHEN n > 1 THEN (v[j] * (20 - (19 * (n + 1) - 20 * j)) + v[j + 1] * (19 * (n + 1) - 20 * j)) / 20 END AS p95 FROM j"
)
def latency_quantiles(spark, d):
    return E.latency(table(spark, d, "etiquetas"), "latencia_ms", "fuente")


@query("WITH u AS (SELECT DISTINCT id, tipo FROM boe_documents) SELECT tipo, count(*) AS total, count(CASE WHEN id IN (SELECT id FROM etiquetas WHERE fuente = 'gold_pre') THEN 1 END) AS hechos FROM u GROUP BY tipo")
def annotation_progress(spark, d):
    done = table(spark, d, "etiquetas").filter(F.col("fuente") == "gold_pre").select("id").distinct().withColumn("x", F.lit(1))
    return table(spark, d, "boe_documents").select("id", "tipo").distinct().join(done, "id", "left").groupBy("tipo").agg(F.count(F.lit(1)).alias("total"), F.count("x").alias("hechos"))


@query("SELECT id, tipo, coalesce(subtipo, '') AS grupo, row_number() OVER (PARTITION BY tipo ORDER BY coalesce(subtipo, ''), id) AS orden FROM (SELECT DISTINCT id, tipo, subtipo FROM boe_documents)")
def annotation_queue(spark, d):
    u = table(spark, d, "boe_documents").select("id", "tipo", F.coalesce("subtipo", F.lit("")).alias("grupo")).distinct()
    return sampling.queued(u, "tipo", "grupo", "id", "orden")


@query("SELECT strftime(fecha, '%Y-%m') AS mes, count(DISTINCT fecha) AS dias, strftime(max(fecha), '%Y-%m-%d') AS ultimo FROM boe_sumario GROUP BY 1")
def report_days(spark, d):
    return table(spark, d, "boe_sumario").groupBy(F.date_format("fecha", "yyyy-MM").alias("mes")).agg(F.countDistinct("fecha").alias("dias"), F.date_format(F.max("fecha"), "yyyy-MM-dd").alias("ultimo"))


# -- normalisers and rules ---------------------------------------------------------------------------------


@query(over_docs(f"id, {amount_sql('texto')} AS euros"))
def norm_amount(spark, d):
    return docs(spark, d).select("id", N.amount(F.col("texto")).alias("euros")).distinct()


@query(over_docs(f"id, {date_sql('texto')} AS fecha"))
def norm_date(spark, d):
    return docs(spark, d).select("id", N.date(F.col("texto")).alias("fecha")).distinct()


POSTS_SQL = r"(?:^|[^\p{L}\p{N}_])([\p{L}\p{N}_]+(?: y [\p{L}\p{N}_]+)?) plazas? (?:de|del)(?:$|[^\p{L}\p{N}_])"


@query(over_docs(f"id, {number_sql(rx('left(texto, 4000)', POSTS_SQL))} AS plazas"))
def norm_number_words(spark, d):
    return docs(spark, d).select("id", N.number(X.group(F.left("texto", F.lit(4000)), rules.POSTS)).alias("plazas")).distinct()


_win = f"coalesce(nullif({after('texto', rules.FILING, 500)}, ''), texto)"
_rest = f"lower(regexp_extract({_win}, {lit('(?is)' + N.TERM + '(.{0,250})')}, 3))"


@query(
    over_docs(
        f"id, {number_sql(rx(_win, N.TERM, 1))} AS dias, CASE lower({rx(_win, N.TERM, 2)}) WHEN 'naturales' THEN 'naturales' WHEN 'hábiles' THEN 'habiles' END AS tipo_plazo, "
        f"CASE WHEN {rx(_win, N.TERM, 2)} IS NULL THEN NULL WHEN {match(_rest, N.STATE)} THEN 'publicacion_boe' WHEN contains({_rest}, 'provincia') THEN 'publicacion_boletin_provincial' WHEN {match(_rest, N.REGIONAL)} THEN 'publicacion_diario_autonomico' END AS desde"
    )
)
def norm_deadline(spark, d):
    x = docs(spark, d).select("id", rules.term(F.col("texto")).alias("p"))
    return x.select("id", F.col("p.dias").alias("dias"), F.col("p.tipo").alias("tipo_plazo"), F.col("p.desde").alias("desde")).distinct()


@query(over_docs(f"id, coalesce({rx('titulo', rules.BODY, 1, False)}, {title_sql('departamento')}) AS organismo"))
def extract_body(spark, d):
    x = docs(spark, d)
    return x.select("id", rules.body(x.titulo, x.departamento).alias("organismo")).distinct()


@query("SELECT DISTINCT departamento, " + title_sql("departamento") + " AS nombre FROM boe_documents")
def title_case(spark, d):
    return table(spark, d, "boe_documents").select("departamento").distinct().select("departamento", X.title_case(F.col("departamento")).alias("nombre"))


_small = "[" + ", ".join(map(lit, X.SMALL)) + "]"
TITLE_ES = f"array_to_string(list_transform(list_filter(string_split(lower(departamento), ' '), lambda w: w <> ''), lambda w, k: CASE WHEN k > 1 AND list_contains({_small}, w) THEN w ELSE upper(w[1]) || w[2:] END), ' ')"


@query(f"SELECT DISTINCT departamento, {TITLE_ES} AS nombre FROM boe_documents")
def title_case_es(spark, d):
    return table(spark, d, "boe_documents").select("departamento").distinct().select("departamento", X.title_case_es(F.col("departamento")).alias("nombre"))


@query(f"WITH x AS (SELECT DISTINCT departamento AS crudo, trim(regexp_replace(trim(departamento), '[,\\s]+$', '')) AS departamento FROM boe_documents) SELECT crudo, CASE WHEN upper(departamento) = departamento AND regexp_matches(departamento, '\\p{{L}}') AND length(departamento) > 6 THEN {TITLE_ES} ELSE departamento END AS nombre FROM x")
def format_strings(spark, d):
    return table(spark, d, "boe_documents").select(F.col("departamento").alias("crudo")).distinct().select("crudo", X.format_string(F.col("crudo")).alias("nombre"))


@query(over_docs(f"id, CASE WHEN texto IS NOT NULL THEN md5({after('texto', rules.TOTAL, 600)}) END AS huella"))
def text_window_after(spark, d):
    return docs(spark, d).select("id", F.md5(X.window_after(F.col("texto"), rules.TOTAL, 600)).alias("huella")).distinct()


@query(over_docs(f"id, {rx('texto', rules.GRANT_ID.replace(chr(92) + 's', ' '), 1, False)} AS bdns_id", "WHERE tipo = 'ayuda'"))
def grant_ids(spark, d):
    return docs(spark, d).filter("tipo = 'ayuda'").select("id", X.group(F.col("texto"), rules.GRANT_ID, 1, "uUd").alias("bdns_id")).distinct()


_first = ", ".join(f"struct_pack(p := strpos(lower(left(texto, 4000)), {lit(k)}), r := {n}, v := {lit(v)})" for n, (k, v) in enumerate((("concurso-oposici", "concurso_oposicion"), ("oposición", "oposicion"), ("oposicion", "oposicion"), ("concurso", "concurso"))))


@query(over_docs(f"id, list_min(list_filter([{_first}], lambda x: x.p > 0)).v AS sistema"))
def first_match(spark, d):
    return docs(spark, d).select("id", X.first_match(F.left("texto", F.lit(4000)), rules.SYSTEM).alias("sistema")).distinct()


#: Sections of codes, which the gazette texts of the tables don't have: one of the main line, one of the list of codes.
def _coded(spark: SparkSession, d: str) -> DataFrame:
    some = table(spark, d, "licitacion").filter("id IS NOT NULL").select("id", F.coalesce("cpv", F.array()).alias("cpv"), F.coalesce("lotes", F.lit(0)).alias("lotes")).distinct()
    listed = F.concat(F.lit("5. Códigos CPV:\n"), F.array_join("cpv", " y "), F.lit(".\n6. Otros: 11111111\n"))
    first = F.concat(F.lit("5.1) CPV principal:\n"), F.coalesce(F.get("cpv", F.lit(0)), F.lit("")), F.lit(".\n6. Códigos CPV: 22222222\n"))
    return some.select("id", F.when(F.col("lotes") % 2 == 0, listed).otherwise(first).alias("texto"))


_CODED_SQL = "SELECT id, CASE WHEN lotes % 2 = 0 THEN '5. Códigos CPV:' || chr(10) || array_to_string(cpv, ' y ') || '.' || chr(10) || '6. Otros: 11111111' || chr(10) ELSE '5.1) CPV principal:' || chr(10) || coalesce(cpv[1], '') || '.' || chr(10) || '6. Códigos CPV: 22222222' || chr(10) END AS texto, cpv, lotes FROM (SELECT DISTINCT id, coalesce(cpv, []) AS cpv, coalesce(lotes, 0) AS lotes FROM licitacion WHERE id IS NOT NULL)"


@query(
    f"WITH d AS ({DOCS_SQL}), c AS ({_CODED_SQL}) SELECT id, 'texto' AS origen, regexp_extract_all(texto, 'CPV: ([0-9]{{8}})', 1) AS cpv FROM d WHERE tipo = 'licitacion' AND texto IS NOT NULL "
    "UNION ALL SELECT DISTINCT id, 'plantilla', CASE WHEN lotes % 2 = 0 THEN list_transform(list_sort(list_transform(list_distinct(cpv), lambda x: struct_pack(k := list_position(cpv, x), x := x))), lambda s: s.x) WHEN len(cpv) > 0 THEN [cpv[1]] ELSE ['22222222'] END FROM c"
)
def extract_codes(spark, d):
    real = docs(spark, d).filter("tipo = 'licitacion' AND texto IS NOT NULL").select("id", F.lit("texto").alias("origen"), "texto")
    both = real.unionByName(_coded(spark, d).withColumn("origen", F.lit("plantilla")))
    return both.select("id", "origen", rules.codes(F.col("texto")).alias("cpv")).distinct()


@query(r"SELECT id, list_max(list_transform(regexp_extract_all(texto, 'Lote (\d+):', 1), lambda x: x::INTEGER)) AS lotes FROM (SELECT id, 'Lote 1: a Lote ' || lotes || ': b' AS texto FROM licitacion WHERE lotes IS NOT NULL)")
def extract_lots(spark, d):
    t = table(spark, d, "licitacion").filter("lotes IS NOT NULL").select("id", F.format_string("Lote 1: a Lote %d: b", "lotes").alias("texto"))
    return t.select("id", rules.lots(F.col("texto")).alias("lotes"))


#: Tender documents in the numbered template, from the tenders themselves: what is planted must come back.
def _template(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "licitacion")
    day = F.concat(F.dayofmonth("fecha_limite_ofertas"), F.lit(" de "), F.element_at(F.array(*map(F.lit, N.MONTHS)), F.month("fecha_limite_ofertas")), F.lit(" de "), F.year("fecha_limite_ofertas"))
    money = F.translate(F.format_number("valor_estimado_eur", 2), ",.", ".,")
    text = F.concat(
        F.lit("1.1) Nombre:\n"), "organo_contratacion", F.lit(".\n3. Descripción de la licitación:\n"), "objeto", F.lit(".\n4. Tipo de procedimiento:\n"), F.coalesce(F.replace("procedimiento", F.lit("_"), F.lit(" ")), F.lit("")),
        F.lit("\n5. Valor estimado:\n"), F.coalesce(F.concat(money, F.lit(" euros.")), F.lit("-")), F.lit("\n6. Plazo para la recepción de ofertas:\nHasta el "), F.coalesce(day, F.lit("-")),
        F.lit("\n7. Duración del contrato:\n"), F.coalesce(F.col("duracion_meses").cast("string"), F.lit("-")), F.lit(" meses\n8. Lugar de ejecución:\n"), F.coalesce("lugar_ejecucion_nuts", F.lit("-")), F.lit("\n"),
    )
    return t.select("id", F.lit("licitacion").alias("tipo"), F.lit(None).cast("string").alias("subtipo"), F.lit("Anuncio").alias("titulo"), F.lit("X").alias("departamento"), text.alias("texto")).distinct()


@query("SELECT DISTINCT id, trim(rtrim(trim(organo_contratacion || '.'), '.')) AS organo, round(valor_estimado_eur, 2) AS euros, fecha_limite_ofertas AS limite, duracion_meses AS meses, lugar_ejecucion_nuts AS nuts FROM licitacion WHERE objeto IS NOT NULL AND organo_contratacion IS NOT NULL")
def extract_tender(spark, d):
    x = _template(spark, d).filter("texto IS NOT NULL")
    x = x.select("id", rules.tender(x.titulo, x.departamento, x.texto).alias("t"))
    return x.select("id", F.col("t.organo_contratacion").alias("organo"), F.round("t.valor_estimado_eur", 2).alias("euros"), F.col("t.fecha_limite_ofertas").alias("limite"), F.col("t.duracion_meses").alias("meses"), F.col("t.lugar_ejecucion_nuts").alias("nuts")).distinct()


@query("SELECT DISTINCT id, trim(rtrim(trim(objeto), '.')) AS objeto FROM licitacion WHERE objeto IS NOT NULL AND organo_contratacion IS NOT NULL")
def label_next_line(spark, d):
    return _template(spark, d).filter("texto IS NOT NULL").select("id", X.label_line(F.col("texto"), "Descripción de la licitación").alias("objeto")).distinct()


@query("SELECT DISTINCT id, nullif(left(trim(objeto), 300), '') AS objeto FROM ayuda WHERE objeto IS NOT NULL")
def section_content(spark, d):
    a = table(spark, d, "ayuda").filter("objeto IS NOT NULL").select("id", F.concat(F.lit("Primero. Beneficiarios:\nx\nSegundo. Objeto:\n"), "objeto", F.lit("\nTercero. Otro\n")).alias("t")).distinct()
    return a.select("id", X.section(F.col("t"), r"Objeto[^.:\n]*").alias("objeto"))


_regimes = ", ".join(f"struct_pack(p := strpos(lower(texto), {lit(k)}), v := {lit(v)})" for k, v in (("concurrencia competitiva", "concurrencia_competitiva"), ("concesión directa", "concesion_directa"), ("concesion directa", "concesion_directa")))


@query(
    over_docs(
        f"id, {rx('texto', rules.GRANT_ID.replace(chr(92) + 's', ' '), 1, False)} AS bdns_id, {amount_sql(after('texto', rules.TOTAL, 600))} AS total, {amount_sql(after('texto', rules.MOST, 200))} AS maximo, list_min(list_filter([{_regimes}], lambda x: x.p > 0)).v AS regimen",
        "WHERE tipo = 'ayuda' AND texto IS NOT NULL",
    )
)
def extract_grant(spark, d):
    x = docs(spark, d).filter("tipo = 'ayuda' AND texto IS NOT NULL")
    x = x.select("id", rules.grant(x.titulo, x.departamento, x.texto).alias("g"))
    return x.select("id", F.col("g.bdns_id"), F.col("g.cuantia_total_eur").alias("total"), F.col("g.importe_max_beneficiario_eur").alias("maximo"), F.col("g.regimen")).distinct()


@query(
    over_docs(
        f"id, coalesce({rx('titulo', rules.BODY, 1, False)}, {title_sql('departamento')}) AS organismo, CASE WHEN {number_sql(rx('left(texto, 4000)', POSTS_SQL))} > 0 THEN {number_sql(rx('left(texto, 4000)', POSTS_SQL))} END AS plazas, {amount_sql(after('texto', rules.FEE, 300))} AS tasa, CASE WHEN subtipo = 'anuncio_local' THEN {rx('left(texto, 4000)', rules.GAZETTE, 1, False)} END AS boletin",
        "WHERE tipo = 'convocatoria'",
    )
)
def extract_job_call(spark, d):
    x = docs(spark, d).filter("tipo = 'convocatoria'")
    x = x.select("id", rules.job_call(x.titulo, x.departamento, x.subtipo, x.texto).alias("c"))
    return x.select("id", F.col("c.organismo"), F.try_element_at("c.plazas", F.lit(1))["numero"].alias("plazas"), F.col("c.tasa_eur").alias("tasa"), F.col("c.boletin_bases").alias("boletin")).distinct()


@query()
def extract_rules(spark, d):
    return rules.extract(docs(spark, d)).distinct()


#: Tokens that the query keeps, few enough that most texts are cut.
KEPT_TOKENS = 150
_piece = r"[ \t\n\f\r]*(?:[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\f\r])"


@query(over_docs(f"id, length(t)::INTEGER AS largo, md5(t) AS huella FROM (SELECT id, CASE WHEN len(p) > {KEPT_TOKENS} THEN array_to_string(p[1:{KEPT_TOKENS}], '') ELSE texto END AS t FROM (SELECT id, texto, regexp_extract_all(texto, {lit(_piece)}) AS p").replace(" FROM d ", " FROM d))"))
def truncate_tokens(spark, d):
    t = docs(spark, d).select("id", X.truncate_tokens(F.col("texto"), KEPT_TOKENS).alias("t"))
    return t.select("id", F.length("t").alias("largo"), F.md5("t").alias("huella")).distinct()


# -- validation, conventions --------------------------------------------------------------------------------


@query("SELECT tipo, valido, count(*) AS n FROM etiquetas GROUP BY tipo, valido")
def validate_payload(spark, d):
    e = table(spark, d, "etiquetas")
    return e.groupBy("tipo", errors(e.tipo, e.json).isNull().alias("valido")).agg(F.count(F.lit(1)).alias("n"))


def workplace(spark: SparkSession, name: str) -> str:
    """A new folder for what a query writes, in the folder that executors share; one of our own only within one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="pliego-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("SELECT id, tipo, json ->> 'organismo' AS organismo, json ->> 'organo_contratacion' AS organo, len(json_keys(json))::INTEGER AS campos FROM etiquetas WHERE valido")
def json_roundtrip(spark, d):
    path = workplace(spark, "registros")
    write_records(table(spark, d, "etiquetas").filter("valido").select("id", "tipo", "json"), path)
    e = read_records(spark, path, "id string, tipo string, json string")
    return e.select("id", "tipo", F.get_json_object("json", "$.organismo").alias("organismo"), F.get_json_object("json", "$.organo_contratacion").alias("organo"), F.size(F.json_object_keys("json")).alias("campos"))


@query("SELECT id, fecha, titulo FROM boe_sumario WHERE fecha = (SELECT max(fecha) FROM boe_sumario)")
def sink_parquet_roundtrip(spark, d):
    """A day is written once: the second write, and one of an empty day, do nothing."""
    s, path = table(spark, d, "boe_sumario").select("id", "fecha", "titulo"), workplace(spark, "dias")
    last = s.agg(F.max("fecha")).first()[0]
    if last is None:
        return s
    one = s.filter(F.col("fecha") == F.lit(last))
    assert write_day(one, path, str(last)) and not write_day(one.limit(1), path, str(last)) and not write_day(one.limit(0), path, "1900-01-01")
    return spark.read.schema("id string, titulo string, fecha date").parquet(path).select("id", "fecha", "titulo")


@query("WITH p AS (SELECT id, unnest(plazas) AS p FROM convocatoria), s AS (SELECT id, p.turno AS turno, sum(p.numero)::BIGINT AS numero FROM p GROUP BY id, p.turno) SELECT id, turno, numero FROM s")
def sum_by_key_array(spark, d):
    c = table(spark, d, "convocatoria").filter("plazas IS NOT NULL").groupBy("id").agg(F.flatten(F.collect_list("plazas")).alias("plazas"))
    return c.select("id", F.explode(V.sum_turns(F.col("plazas"))).alias("p")).select("id", "p.turno", F.col("p.numero").cast("long").alias("numero"))


@query(over_docs(f"id, CASE WHEN {match('titulo', V.ACCESS)} THEN FALSE ELSE {match('titulo', V.POST_TITLE)} OR ({match('texto', V.POST_TEXT)} AND NOT {match('texto', V.FREE_TURN)}) END AS provision"))
def conv_is_provision(spark, d):
    x = docs(spark, d)
    return x.select("id", V.is_provision(x.titulo, x.texto).alias("provision")).distinct()


@query(f"WITH d AS ({DOCS_SQL}) SELECT a.id, a.regimen, CASE WHEN {match('d.texto', V.REGIME)} THEN a.regimen END AS alineado FROM (SELECT id, max(regimen) AS regimen FROM ayuda GROUP BY id) a JOIN d ON a.id = d.id")
def conv_regime(spark, d):
    a = table(spark, d, "ayuda").groupBy("id").agg(F.max("regimen").alias("regimen")).join(docs(spark, d).select("id", "texto"), "id")
    return a.select("id", "regimen", V.regime(a.regimen, a.texto).alias("alineado")).distinct()


@query(f"WITH x AS (SELECT DISTINCT id, bases_reguladoras AS bases FROM ayuda) SELECT id, CASE WHEN {match('bases', V.NORM[:-2] + '(?:$|[^a-z])', False)} THEN coalesce({rx('bases', V.CITATION)}, bases) ELSE bases END AS bases FROM x")
def conv_citation(spark, d):
    return table(spark, d, "ayuda").select("id", F.col("bases_reguladoras").alias("bases")).distinct().select("id", V.citation(F.col("bases")).alias("bases"))


@query("SELECT DISTINCT id, plazo_solicitudes.dias AS antes, CASE WHEN plazo_solicitudes.fecha_fin IS NULL AND (plazo_solicitudes.dias IS NULL OR plazo_solicitudes.dias = 1) AND plazo_solicitudes IS NOT NULL THEN 30 ELSE plazo_solicitudes.dias END AS dias FROM convocatoria")
def conv_deadline_month(spark, d):
    c = table(spark, d, "convocatoria").select("id", F.col("plazo_solicitudes").alias("p"), F.lit("El plazo de presentación de solicitudes será de un mes.").alias("t"))
    return c.select("id", F.col("p.dias").alias("antes"), V.term_month(c.p, c.t)["dias"].alias("dias")).distinct()


_mes = f"([{', '.join(map(lit, N.MONTHS))}])[month(f)]"


@query("WITH x AS (SELECT DISTINCT fecha_limite_ofertas AS f FROM licitacion WHERE fecha_limite_ofertas IS NOT NULL) SELECT f, CASE day(f) % 3 WHEN 0 THEN 'otro' WHEN 1 THEN 'publicacion_boe' END AS desde FROM x")
def conv_deadline_start(spark, d):
    x = table(spark, d, "licitacion").select(F.col("fecha_limite_ofertas").alias("f")).filter("f IS NOT NULL").distinct()
    lead = F.when(F.dayofmonth("f") % 3 == 0, "Se iniciará el día 3 de enero y acaba el ").when(F.dayofmonth("f") % 3 == 1, "Desde su publicación, acaba el ").otherwise("Acaba el ")
    text = F.concat(lead, F.dayofmonth("f"), F.lit(" de "), F.element_at(F.array(*map(F.lit, N.MONTHS)), F.month("f")), F.lit(" de "), F.year("f"), F.lit("."))
    p = F.struct(F.lit(None).cast("int").alias("dias"), F.lit(None).cast("string").alias("tipo"), F.lit("otro").alias("desde"), F.col("f").alias("fecha_fin"))
    return x.select("f", V.term_start(p, text)["desde"].alias("desde"))


@query(over_docs("id, (CASE WHEN texto IS NULL THEN -1 ELSE len(list_distinct(list_transform(regexp_extract_all(left(texto, 3000), '(?im)^[\\p{L}\\p{N}_]+ (?:plazas?|puestos?) de ([^,.]+?)(?:,| pertenecientes?| por el)', 1), lambda x: lower(trim(x))))) END)::INTEGER AS puestos").replace("-1", "NULL"))
def distinct_posts(spark, d):
    return docs(spark, d).select("id", F.when(F.col("texto").isNotNull(), V.many_posts(F.col("texto"))).alias("puestos")).distinct()


def _align_sql(t: str) -> str:
    """A payload's columns under the conventions; x holds a row of the table, its title and text."""
    p = "x.plazo_solicitudes"
    month = f"({p}.fecha_fin IS NULL AND coalesce({p}.dias, 1) = 1 AND {match(after('x.texto', V.FILING, 400), '(?:^|[^a-z0-9_])un mes(?:$|[^a-z0-9_])')})"
    day, year = f"day({p}.fecha_fin)", f"year({p}.fecha_fin)"
    name = f"'(?:^|[^a-z0-9_])0?' || {day} || ' de ' || ([{', '.join(map(lit, N.MONTHS))}])[month({p}.fecha_fin)]"
    full, short = (f"'(?s)^(.*?)' || {name}{y}" for y in (f" || ' de ' || {year}", ""))
    low = "lower(coalesce(x.texto, ''))"
    before = f"right(CASE WHEN regexp_matches({low}, {full}) THEN regexp_extract({low}, {full}, 1) WHEN regexp_matches({low}, {short}) THEN regexp_extract({low}, {short}, 1) ELSE '' END, 299)"
    since = f"CASE WHEN {match(before, V.FIXED_START)} THEN 'otro' WHEN contains({before}, 'publicaci') THEN 'publicacion_boe' END"
    term = f"CASE WHEN {month} THEN 30 ELSE {p}.dias END AS dias, CASE WHEN {month} THEN 'naturales' ELSE {p}.tipo END AS tipo_plazo, CASE WHEN {p}.fecha_fin IS NOT NULL AND {p}.dias IS NULL THEN {since} ELSE {p}.desde END AS desde"
    if t == "ayuda":
        bases = f"CASE WHEN {match('x.bases_reguladoras', V.NORM[:-2] + '(?:$|[^a-z])', False)} THEN coalesce({rx('x.bases_reguladoras', V.CITATION)}, x.bases_reguladoras) ELSE x.bases_reguladoras END"
        return f"SELECT x.id, 'ayuda' AS tipo, {term}, CASE WHEN {match('x.texto', V.REGIME)} THEN x.regimen END AS regimen, {bases} AS bases, NULL AS puesto, NULL AS plazas FROM x"
    provision = f"(NOT {match('x.titulo', V.ACCESS)} AND ({match('x.titulo', V.POST_TITLE)} OR ({match('x.texto', V.POST_TEXT)} AND NOT {match('x.texto', V.FREE_TURN)})))"
    turns = f"list_transform(x.plazas, lambda p: struct_pack(t := CASE WHEN p.turno = 'libre' AND {provision} THEN 'otro' ELSE p.turno END, n := p.numero))"
    summed = "array_to_string(list_sort(list_transform(list_distinct(list_transform(tt, lambda p: p.t)), lambda t: t || ':' || list_sum(list_transform(list_filter(tt, lambda p: p.t = t), lambda p: p.n))::BIGINT)), ',')"
    names = "len(list_distinct(list_transform(regexp_extract_all(left(x.texto, 3000), '(?im)^[\\p{L}\\p{N}_]+ (?:plazas?|puestos?) de ([^,.]+?)(?:,| pertenecientes?| por el)', 1), lambda w: lower(trim(w)))))"
    return f"SELECT x.id, 'convocatoria' AS tipo, {term}, NULL AS regimen, NULL AS bases, CASE WHEN {names} <= 1 THEN x.puesto END AS puesto, {summed} AS plazas FROM (SELECT x.*, {turns} AS tt FROM x) x"


_joined = lambda t: f"SELECT DISTINCT t.*, d.titulo, d.texto FROM {t} t JOIN d ON t.id = d.id WHERE d.texto IS NOT NULL AND d.titulo IS NOT NULL"


@query(f"WITH d AS ({DOCS_SQL}), ay AS ({_align_sql('ayuda').replace('FROM x', 'FROM (' + _joined('ayuda') + ') x')}), co AS ({_align_sql('convocatoria').replace('FROM x)', 'FROM (' + _joined('convocatoria') + ') x)')}) SELECT * FROM ay UNION ALL SELECT * FROM co")
def conv_align(spark, d):
    text = docs(spark, d).select("id", "titulo", "texto").filter("texto IS NOT NULL AND titulo IS NOT NULL")
    none = F.lit(None).cast("string")
    out = None
    for tipo in ("ayuda", "convocatoria"):
        x = table(spark, d, tipo).distinct().join(text, "id")
        x = x.select("id", V.align(tipo, F.struct(*[f.name for f in struct(tipo).fields]), F.col("titulo"), F.col("texto")).alias("v"))
        turns = F.array_join(F.array_sort(F.transform("v.plazas", lambda p: F.concat_ws(":", p["turno"], p["numero"]))), ",") if tipo == "convocatoria" else none
        term = F.col("v.plazo_solicitudes")
        regime = (F.col("v.regimen"), F.col("v.bases_reguladoras")) if tipo == "ayuda" else (none, none)
        one = x.select("id", F.lit(tipo).alias("tipo"), term["dias"].alias("dias"), term["tipo"].alias("tipo_plazo"), term["desde"].alias("desde"), regime[0].alias("regimen"), regime[1].alias("bases"), (F.col("v.puesto") if tipo == "convocatoria" else none).alias("puesto"), turns.alias("plazas")).distinct()
        out = one if out is None else out.unionByName(one)
    return out


# -- display -------------------------------------------------------------------------------------------------


@query("SELECT id, CASE WHEN valor_estimado_eur IS NULL THEN '' ELSE replace(format('{:,}', round_even(valor_estimado_eur, 0)::BIGINT), ',', '.') || ' €' END AS euros FROM licitacion")
def format_euros(spark, d):
    return table(spark, d, "licitacion").select("id", N.euros(F.col("valor_estimado_eur")).alias("euros"))


_p = "plazo_solicitudes"


@query(f"SELECT id, CASE WHEN {_p}.dias > 0 THEN {_p}.dias::VARCHAR || ' días' || CASE {_p}.tipo WHEN 'habiles' THEN ' hábiles' WHEN 'naturales' THEN ' naturales' ELSE '' END WHEN {_p}.fecha_fin IS NOT NULL THEN 'hasta el ' || {_p}.fecha_fin::VARCHAR ELSE '' END AS plazo FROM convocatoria")
def format_deadline(spark, d):
    return table(spark, d, "convocatoria").select("id", report.term(F.col("plazo_solicitudes")).alias("plazo"))


@query("SELECT id, array_to_string(list_transform(plazas, lambda p: p.numero::VARCHAR || ' ' || CASE p.turno WHEN 'promocion_interna' THEN 'promoción interna' WHEN 'otro' THEN 'otro turno' ELSE p.turno END), ', ') AS plazas FROM convocatoria WHERE plazas IS NOT NULL")
def format_posts(spark, d):
    return table(spark, d, "convocatoria").filter("plazas IS NOT NULL").select("id", report.posts(F.col("plazas")).alias("plazas"))


_esc = lambda c: f"replace(replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


@query(f"SELECT DISTINCT departamento, {_esc('departamento')} AS html FROM boe_documents")
def html_escape(spark, d):
    return table(spark, d, "boe_documents").select("departamento").distinct().select("departamento", X.html_escape(F.col("departamento")).alias("html"))


@query(f"SELECT id, '<tr><td>' || {_esc('organo_contratacion')} || '</td><td>' || {_esc(chr(99) + 'oalesce(objeto, ' + chr(39) * 2 + ')')} || '</td><td>' || CASE WHEN valor_estimado_eur IS NULL THEN '' ELSE replace(format('{{:,}}', round_even(valor_estimado_eur, 0)::BIGINT), ',', '.') || ' €' END || '</td><td>' || coalesce(fecha_limite_ofertas::VARCHAR, '') || '</td></tr>' AS fila FROM licitacion WHERE organo_contratacion IS NOT NULL")
def report_rows(spark, d):
    t = table(spark, d, "licitacion").filter("organo_contratacion IS NOT NULL")
    return t.select("id", report.row(report.cells("licitacion", F.struct(*t.columns))).alias("fila"))


@query(over_docs("id, array_to_string(list_filter(list_transform(string_split(texto, chr(10)), lambda x: trim(regexp_replace(x, '[ \\t\\x0B\\f\\r\\x{85}\\x{A0}\\x{2000}-\\x{200A}\\x{202F}\\x{3000}]+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS texto", "WHERE texto IS NOT NULL"))
def html_to_text(spark, d):
    x = docs(spark, d).filter("texto IS NOT NULL")
    page = F.concat(F.lit("<html><style>p {x: y}</style><script>var a = '</p>';</script><!-- <p> -->"), F.concat_ws("", F.transform(F.split("texto", "\n"), lambda line: F.concat(F.lit("<p><b>"), X.html_escape(line), F.lit("</b>")))), F.lit("</html>"))
    return x.select("id", X.html_text(page).alias("texto")).dropDuplicates(["id"])


# -- tokens and scores ----------------------------------------------------------------------------------------


@query(f"SELECT id, {words_sql('departamento')} AS palabras FROM boe_documents WHERE departamento IS NOT NULL")
def tokenize(spark, d):
    return table(spark, d, "boe_documents").filter("departamento IS NOT NULL").select("id", X.tokens(F.col("departamento")).alias("palabras"))


@query(f"WITH x AS (SELECT row_id, departamento, titulo, {words_sql('departamento')} AS a, {words_sql('titulo')} AS b FROM hf WHERE departamento IS NOT NULL AND titulo IS NOT NULL) SELECT row_id, round({f1_sql('a', 'b')}, 9) AS f1 FROM x")
def token_f1(spark, d):
    return table(spark, d, "hf").filter("departamento IS NOT NULL AND titulo IS NOT NULL").select("row_id", F.round(X.token_f1(F.col("departamento"), F.col("titulo")), 9).alias("f1"))


#: Gold: what the tables of extractions hold for an id; prediction: its last label.
_LABEL = ("ts", "fuente", "json", "valido", "sin_prellenado")


def _scores(spark: SparkSession, d: str) -> DataFrame:
    label = table(spark, d, "etiquetas").select("id", "ts", "fuente", F.coalesce("json", F.lit("")).alias("json"), F.coalesce("valido", F.lit(False)).alias("valido"), F.coalesce("sin_prellenado", F.lit(False)).alias("sin_prellenado"))
    gold = {t: table(spark, d, t).distinct() for t in PAYLOAD}
    ids = gold["convocatoria"].select("id").unionByName(gold["ayuda"].select("id")).unionByName(gold["licitacion"].select("id"))
    texts = docs(spark, d).select("id", "texto").join(ids, "id", "left_semi").dropDuplicates(["id"])
    return E.evaluation(gold, sampling.latest(label, "id", *_LABEL), texts)


def _field_sql(tipo: str, path: str) -> str:
    """A field's rows: gold and predicted value as text, lists as lists of texts."""
    kind = kinds(tipo)[path]
    g, p = f"g.{path}", f"(CASE WHEN valido THEN json END ->> {lit('$.' + path)})"
    how, text, lists = "igual", (f"{g}::VARCHAR", p), ("NULL::VARCHAR[]", "NULL::VARCHAR[]")
    if path in ("cpv", "plazas"):
        of = "lambda x: x" if path == "cpv" else "lambda x: concat_ws(':', x.turno, x.numero)"
        shape = '["VARCHAR"]' if path == "cpv" else '[{"turno":"VARCHAR","numero":"INTEGER"}]'
        how, text, lists = "lista", ("NULL", "NULL"), (f"list_transform({g}, {of})", f"list_transform(from_json({p}, {lit(shape)}), {of})")
    elif kind == "double":
        how, text = "importe", (f"{g}::VARCHAR", f"{p}::DOUBLE::VARCHAR")
    elif path.split(".")[0] in E.TEXT:
        how = "texto"
    check = "lista" if path == "cpv" else "literal" if path.split(".")[0] in LITERAL else "importe" if kind == "double" else "fecha" if kind == "date" else "no"
    return f"SELECT g.id, {lit(tipo)} AS tipo, {lit(path)} AS campo, sin, coalesce(valido, FALSE) AS valido, {lit(how)} AS how, {lit(check)} AS mira, {text[0]} AS g, {text[1]} AS p, {lists[0]} AS gl, {lists[1]} AS pl FROM (SELECT DISTINCT * FROM {tipo}) g LEFT JOIN lab ON g.id = lab.id"


_months = f"[{', '.join(map(lit, N.MONTHS))}]"
SCORES_SQL = (
    "WITH lab AS (SELECT id, j.json AS json, j.valido AS valido, j.sin AS sin FROM (SELECT id, max(struct_pack(ts := ts, fuente := fuente, json := coalesce(json, ''), valido := coalesce(valido, FALSE), sin := coalesce(sin_prellenado, FALSE))) AS j FROM etiquetas GROUP BY id)), "
    "l AS (" + " UNION ALL ".join(_field_sql(t, f) for t in PAYLOAD for f in fields(t)) + "), "
    f"w AS (SELECT *, CASE WHEN how = 'texto' THEN {words_sql('g')} END AS a, CASE WHEN mira = 'literal' THEN {words_sql('p')} END AS b FROM l), "
    f"s AS (SELECT *, CASE WHEN g IS NULL OR p IS NULL THEN NULL WHEN how = 'texto' THEN {f1_sql('a', 'b')} WHEN how = 'importe' THEN (abs(g::DOUBLE - p::DOUBLE) <= 0.01)::INTEGER::DOUBLE ELSE (g = p)::INTEGER::DOUBLE END AS sim, list_distinct(coalesce(gl, [])) AS x, list_distinct(coalesce(pl, [])) AS y FROM w), "
    "r AS (SELECT *, CASE WHEN how = 'lista' THEN len(list_intersect(x, y)) WHEN g IS NULL OR p IS NULL THEN 0 ELSE sim END::DOUBLE AS tp, CASE WHEN how = 'lista' THEN len(list_filter(y, lambda v: NOT list_contains(x, v))) WHEN p IS NULL THEN 0 WHEN g IS NULL THEN 1 ELSE 1 - sim END::DOUBLE AS fp, "
    "CASE WHEN how = 'lista' THEN len(list_filter(x, lambda v: NOT list_contains(y, v))) WHEN g IS NULL THEN 0 WHEN p IS NULL THEN 1 ELSE 1 - sim END::DOUBLE AS fn FROM s), "
)
#: The same with whether the prediction is missing from the text.
SEEN_SQL = (
    SCORES_SQL + f"dd AS ({DOCS_SQL}), tx AS (SELECT id, coalesce(texto, '') AS t, {words_sql('coalesce(texto, chr(32))')} AS tw FROM dd), "
    "h AS (SELECT r.*, CASE mira WHEN 'lista' THEN CASE WHEN len(pl) > 0 THEN len(list_filter(pl, lambda v: NOT list_contains(coalesce(tw, []), v))) > 0 END WHEN 'literal' THEN CASE WHEN p IS NOT NULL THEN len(list_filter(b, lambda v: list_contains(coalesce(tw, []), v))) < len(b) / 2 END "
    "WHEN 'importe' THEN CASE WHEN p IS NOT NULL THEN NOT (contains(coalesce(t, ''), replace(format('{:,}', split_part(format('{:.2f}', p::DOUBLE), '.', 1)::BIGINT), ',', '.')) OR contains(coalesce(t, ''), split_part(format('{:.2f}', p::DOUBLE), '.', 1))) OR (split_part(format('{:.2f}', p::DOUBLE), '.', 2) <> '00' AND NOT contains(coalesce(t, ''), ',' || split_part(format('{:.2f}', p::DOUBLE), '.', 2))) END "
    "WHEN 'fecha' THEN CASE WHEN p IS NOT NULL THEN NOT regexp_matches(coalesce(t, ''), '(?i)(?:^|[^\\p{L}\\p{N}_])0?' || day(p::DATE) || ' de ' || (" + _months + ")[month(p::DATE)] || ' de ' || year(p::DATE) || '|' || day(p::DATE) || '/' || strftime(p::DATE, '%m') || '/' || year(p::DATE)) END END AS alucinado FROM r LEFT JOIN tx ON r.id = tx.id), "
)
_f1 = lambda tp, fp, fn: f"CASE WHEN {tp} + {fp} + {fn} = 0 THEN 1.0 ELSE 2 * {tp} / (2 * {tp} + {fp} + {fn}) END::DOUBLE"
_by = f"f AS (SELECT tipo, campo, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, avg((fp = 0 AND fn = 0)::INTEGER) AS exacto, {_f1('sum(tp)', 'sum(fp)', 'sum(fn)')} AS f1 FROM r GROUP BY tipo, campo) "
_free = "campo IN ('objeto', 'beneficiarios')"
_sum = lambda c, w: f"coalesce(sum(CASE WHEN {w} THEN {c} END), 0)"
_pooled = lambda w: _f1(*[_sum(c, w) for c in ("tp", "fp", "fn")])


@query(SCORES_SQL.replace(", r AS", ", r0 AS").rstrip(", ") + " SELECT id, tipo, campo, CASE WHEN how = 'lista' THEN len(pl)::VARCHAR WHEN how = 'importe' THEN format('{:.2f}', p::DOUBLE) ELSE p END AS valor FROM l")
def eval_flatten(spark, d):
    label = table(spark, d, "etiquetas").select("id", "ts", "fuente", F.coalesce("json", F.lit("")).alias("json"), F.coalesce("valido", F.lit(False)).alias("valido"), F.coalesce("sin_prellenado", F.lit(False)).alias("sin_prellenado"))
    label = sampling.latest(label, "id", *_LABEL)

    def shown(path: str, c):
        if path in E.LISTS:
            return F.when(c.isNotNull(), F.size(c)).cast("string")
        return F.when(c.isNotNull(), F.format_string("%.2f", c)) if path in E.AMOUNTS else c.cast("string")

    out = None
    for tipo in PAYLOAD:
        x = table(spark, d, tipo).select("id").distinct().join(label, "id", "left").select("id", F.when(F.col("valido"), F.from_json("json", struct(tipo))).alias("p"))
        one = x.select("id", F.lit(tipo).alias("tipo"), F.explode(F.array(*[F.struct(F.lit(k).alias("campo"), shown(k, c).alias("valor")) for k, c in E.flatten(tipo, F.col("p")).items()])).alias("r")).select("id", "tipo", "r.*")
        out = one if out is None else out.unionByName(one)
    return out


@query(SCORES_SQL.rstrip(", ") + " SELECT id, tipo, campo, round(tp, 6) AS similitud FROM r WHERE how <> 'lista' AND g IS NOT NULL AND p IS NOT NULL")
def eval_similarity(spark, d):
    return _scores(spark, d).filter("similitud IS NOT NULL").select("id", "tipo", "campo", F.round("similitud", 6).alias("similitud"))


@query(SCORES_SQL.rstrip(", ") + " SELECT id, tipo, campo, round(tp, 6) AS tp, round(fp, 6) AS fp, round(fn, 6) AS fn FROM r")
def eval_count(spark, d):
    return _scores(spark, d).select("id", "tipo", "campo", *[F.round(c, 6).alias(c) for c in ("tp", "fp", "fn")])


@query(SCORES_SQL + _by + "SELECT tipo, campo, round(tp, 4) AS tp, round(fp, 4) AS fp, round(fn, 4) AS fn FROM f")
def eval_field_counts(spark, d):
    return E.by_field(_scores(spark, d), "tipo").select("tipo", "campo", *[F.round(c, 4).alias(c) for c in ("tp", "fp", "fn")])


@query(SCORES_SQL + _by + "SELECT tipo, campo, round(f1, 6) AS f1, round(exacto, 6) AS exacto FROM f")
def eval_field_f1(spark, d):
    return E.by_field(_scores(spark, d), "tipo").select("tipo", "campo", F.round("f1", 6).alias("f1"), F.round("exacto", 6).alias("exacto"))


@query(SCORES_SQL + _by + f"SELECT round({_pooled('NOT ' + _free)}, 6) AS micro FROM f")
def eval_micro(spark, d):
    return E.summary(E.by_field(_scores(spark, d), "tipo")).select(F.round("micro", 6).alias("micro"))


@query(SCORES_SQL + _by + f"SELECT round(avg(f1), 6) AS macro FROM f WHERE NOT {_free}")
def eval_macro(spark, d):
    return E.summary(E.by_field(_scores(spark, d), "tipo")).select(F.round("macro", 6).alias("macro"))


@query(SCORES_SQL + _by + f"SELECT round({_pooled(_free)}, 6) AS texto_libre FROM f")
def eval_free_text(spark, d):
    return E.summary(E.by_field(_scores(spark, d), "tipo")).select(F.round("texto_libre", 6).alias("texto_libre"))


@query(SCORES_SQL + _by + "SELECT tipo || '/' || campo AS campo, format('| {} | {:.3f} | {:.3f} |', tipo || '/' || campo, f1, exacto) AS linea FROM f")
def metrics_table(spark, d):
    return report.markdown(E.by_field(_scores(spark, d), "tipo").withColumn("campo", F.concat_ws("/", "tipo", "campo")))


@query(SCORES_SQL + _by + "SELECT campo, m.k AS metrica, round(m.v, 6) AS valor FROM (SELECT tipo || '.' || campo AS campo, unnest([struct_pack(k := 'f1', v := f1), struct_pack(k := 'exacto', v := exacto::DOUBLE)]) AS m FROM f)")
def metrics_long(spark, d):
    f = E.by_field(_scores(spark, d), "tipo")
    return f.select(F.concat_ws(".", "tipo", "campo").alias("campo"), F.explode(F.create_map(F.lit("f1"), "f1", F.lit("exacto"), "exacto")).alias("metrica", "v")).select("campo", "metrica", F.round("v", 6).alias("valor"))


@query(
    SEEN_SQL + "n AS (SELECT *, 'todo' AS poblacion FROM h UNION ALL SELECT *, tipo FROM h UNION ALL SELECT *, 'sin_prellenado' FROM h WHERE sin), "
    f"f AS (SELECT poblacion, tipo, campo, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, count(*) AS n, sum(valido::INTEGER) AS ok, sum(alucinado::INTEGER) AS mal, count(alucinado) AS vistos, {_f1('sum(tp)', 'sum(fp)', 'sum(fn)')} AS f1 FROM n GROUP BY poblacion, tipo, campo) "
    "SELECT poblacion, sum(CASE WHEN campo IN ('organismo', 'organo_contratacion') THEN n END)::BIGINT AS documentos, round(sum(CASE WHEN campo IN ('organismo', 'organo_contratacion') THEN ok END) / sum(CASE WHEN campo IN ('organismo', 'organo_contratacion') THEN n END), 6) AS validos, "
    f"round(coalesce(sum(mal) / nullif(sum(vistos), 0), 0), 6)::DOUBLE AS alucinacion, round({_pooled('NOT ' + _free)}, 6) AS micro, round(avg(CASE WHEN NOT {_free} THEN f1 END), 6) AS macro, round({_pooled(_free)}, 6) AS texto_libre FROM f GROUP BY poblacion"
)
def eval_rollup(spark, d):
    return E.populations(_scores(spark, d)).select("poblacion", "documentos", *[F.round(c, 6).alias(c) for c in ("validos", "alucinacion", "micro", "macro", "texto_libre")])


@query(SEEN_SQL.rstrip(", ") + " SELECT tipo, campo, sum(alucinado::INTEGER)::BIGINT AS alucinados, count(alucinado) AS comprobados, round(coalesce(avg(alucinado::INTEGER), 0), 6) AS tasa FROM h GROUP BY tipo, campo HAVING count(alucinado) > 0")
def halluc_rate(spark, d):
    a = F.col("alucinado").cast("int")
    return _scores(spark, d).groupBy("tipo", "campo").agg(F.sum(a).alias("alucinados"), F.count(a).alias("comprobados"), F.round(F.avg(a), 6).alias("tasa")).filter("comprobados > 0")


@query("WITH g AS (SELECT DISTINCT ON (id) id, cpv FROM licitacion ORDER BY id, cpv), p AS (SELECT id, regexp_extract_all(max(texto), 'CPV: (\\d{8})', 1) AS c FROM boe_documents WHERE texto IS NOT NULL GROUP BY id) SELECT g.id, len(list_intersect(list_distinct(coalesce(cpv, [])), list_distinct(c)))::DOUBLE AS tp, len(list_filter(list_distinct(c), lambda x: NOT list_contains(coalesce(cpv, []), x)))::DOUBLE AS fp, len(list_filter(list_distinct(coalesce(cpv, [])), lambda x: NOT list_contains(c, x)))::DOUBLE AS fn FROM g JOIN p ON g.id = p.id")
def set_prf(spark, d):
    g = table(spark, d, "licitacion").groupBy("id").agg(F.min(F.coalesce("cpv", F.array())).alias("cpv"))
    p = docs(spark, d).filter("texto IS NOT NULL").select("id", F.regexp_extract_all("texto", F.lit(r"CPV: (\d{8})"), F.lit(1)).alias("c"))
    x = g.join(p, "id")
    return x.select("id", E.counts("cpv", x.cpv, x.c).alias("r")).select("id", "r.*").distinct()


@query(f"WITH d AS ({DOCS_SQL}), x AS (SELECT DISTINCT a.id, a.objeto AS v, coalesce(d.texto, '') AS t FROM ayuda a JOIN d ON a.id = d.id WHERE a.objeto IS NOT NULL), w AS (SELECT id, v, {words_sql('v')} AS a, {words_sql('t')} AS b FROM x) SELECT id, v, len(list_filter(a, lambda y: list_contains(b, y))) < len(a) / 2 AS alucinado FROM w")
def halluc_literal(spark, d):
    x = table(spark, d, "ayuda").filter("objeto IS NOT NULL").select("id", F.col("objeto").alias("v")).distinct().join(docs(spark, d).select("id", F.coalesce("texto", F.lit("")).alias("t")), "id")
    return x.select("id", "v", E.hallucinated_literal(x.v, x.t).alias("alucinado")).distinct()


@query(f"WITH d AS ({DOCS_SQL}), x AS (SELECT DISTINCT l.id, valor_estimado_eur AS v, coalesce(d.texto, '') AS t FROM licitacion l JOIN d ON l.id = d.id WHERE valor_estimado_eur IS NOT NULL), w AS (SELECT *, format('{{:.2f}}', v) AS s FROM x) SELECT id, v, NOT (contains(t, replace(format('{{:,}}', split_part(s, '.', 1)::BIGINT), ',', '.')) OR contains(t, split_part(s, '.', 1))) OR (split_part(s, '.', 2) <> '00' AND NOT contains(t, ',' || split_part(s, '.', 2))) AS alucinado FROM w")
def halluc_amount(spark, d):
    x = table(spark, d, "licitacion").filter("valor_estimado_eur IS NOT NULL").select("id", F.col("valor_estimado_eur").alias("v")).distinct().join(docs(spark, d).select("id", F.coalesce("texto", F.lit("")).alias("t")), "id")
    return x.select("id", "v", E.hallucinated_amount(x.v, x.t).alias("alucinado")).distinct()


@query(f"WITH d AS ({DOCS_SQL}), x AS (SELECT DISTINCT l.id, fecha_limite_ofertas AS f, coalesce(d.texto, '') AS t FROM licitacion l JOIN d ON l.id = d.id WHERE fecha_limite_ofertas IS NOT NULL) SELECT id, f, NOT regexp_matches(t, '(?i)(?:^|[^\\p{{L}}\\p{{N}}_])0?' || day(f) || ' de ' || {_mes} || ' de ' || year(f) || '|' || day(f) || '/' || strftime(f, '%m') || '/' || year(f)) AS alucinado FROM x")
def halluc_date(spark, d):
    x = table(spark, d, "licitacion").filter("fecha_limite_ofertas IS NOT NULL").select("id", F.col("fecha_limite_ofertas").alias("f")).distinct().join(docs(spark, d).select("id", F.coalesce("texto", F.lit("")).alias("t")), "id")
    return x.select("id", "f", E.hallucinated_date(x.f, x.t).alias("alucinado")).distinct()


# -- sources ------------------------------------------------------------------------------------------------------


def _summary_xml(spark: SparkSession, d: str) -> DataFrame:
    """One summary per row of boe_sumario, as XML."""
    attr = lambda n, c: F.coalesce(F.concat(F.lit(f' {n}="'), X.html_escape(F.col(c).cast("string")), F.lit('"')), F.lit(""))
    s = table(spark, d, "boe_sumario").distinct()
    item = F.concat(F.lit("<item><identificador>"), "id", F.lit("</identificador><titulo>"), X.html_escape(F.col("titulo")), F.lit("</titulo><url_pdf"), attr("szKBytes", "pdf_kb"), attr("pagina_inicial", "pagina_inicial"), F.lit(">u</url_pdf></item>"))
    inner = F.when(F.col("epigrafe").isNotNull(), F.concat(F.lit("<epigrafe"), attr("nombre", "epigrafe"), F.lit(">"), item, F.lit("</epigrafe>"))).otherwise(item)
    xml = F.concat(F.lit("<sumario><metadatos><fecha_publicacion>"), F.date_format("fecha", "yyyyMMdd"), F.lit("</fecha_publicacion></metadatos><diario"), attr("numero", "diario_numero"), F.lit("><seccion"), attr("codigo", "seccion"), F.lit("><departamento"), attr("codigo", "departamento_codigo"), F.lit(">"), inner, F.lit("</departamento></seccion></diario></sumario>"))
    return s.select(xml.alias("xml"))


@query("SELECT id, fecha, diario_numero, seccion, departamento_codigo, epigrafe, titulo, pagina_inicial, pdf_kb FROM (SELECT DISTINCT * FROM boe_sumario) WHERE seccion IS DISTINCT FROM '2A'")
def xml_summary_flatten(spark, d):
    from pliego.sources.xml import flatten_summary

    return flatten_summary(_summary_xml(spark, d).filter("xml IS NOT NULL"), "xml").select("id", "fecha", "diario_numero", "seccion", "departamento_codigo", "epigrafe", "titulo", "pagina_inicial", "pdf_kb")


def _document_xml(spark: SparkSession, d: str) -> DataFrame:
    esc = lambda c: X.html_escape(c)
    t = table(spark, d, "licitacion").filter("objeto IS NOT NULL AND organo_contratacion IS NOT NULL").select("id", "objeto", "organo_contratacion").distinct()
    return t.select("id", "objeto", "organo_contratacion", F.concat(F.lit("<documento><metadatos><rango>Anuncio</rango></metadatos><analisis><nota>"), esc(F.col("objeto")), F.lit("</nota><nota> </nota><alerta>x</alerta></analisis><texto><p>"), esc(F.col("objeto")), F.lit("</p><table><tr><td>"), esc(F.col("organo_contratacion")), F.lit("</td><td>y</td></tr></table><p></p></texto></documento>")).alias("xml"))


_sq = lambda c: f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


@query(f"SELECT DISTINCT id, 'Anuncio' AS rango, {_sq('objeto')} || chr(10) || {_sq('organo_contratacion')} || ' | y' AS texto FROM licitacion WHERE objeto IS NOT NULL AND organo_contratacion IS NOT NULL")
def xml_document_parse(spark, d):
    from pliego.sources.xml import parse_documents

    return parse_documents(_document_xml(spark, d), "id", "xml").select("id", "rango", "texto").distinct()


@query(f"SELECT DISTINCT id, {_sq('objeto')} AS nota, 'x' AS alerta FROM licitacion WHERE objeto IS NOT NULL AND organo_contratacion IS NOT NULL")
def xml_leaf_map(spark, d):
    from pliego.sources.xml import parse_documents

    x = parse_documents(_document_xml(spark, d), "id", "xml").select("id", F.from_json("analisis", "map<string,array<string>>").alias("m"))
    return x.select("id", F.col("m")["nota"][0].alias("nota"), F.col("m")["alerta"][0].alias("alerta")).distinct()


@query(f"SELECT DISTINCT id, {_sq('organo_contratacion')} || ' | y' AS fila FROM licitacion WHERE objeto IS NOT NULL AND organo_contratacion IS NOT NULL")
def html_table_rows(spark, d):
    from pliego.sources.xml import parse_documents

    x = parse_documents(_document_xml(spark, d), "id", "xml")
    return x.select("id", F.split("texto", "\n")[1].alias("fila")).distinct()


@query("SELECT id, try_cast(CASE WHEN regexp_full_match(split_part(id, '-', 4), '[0-9]+') THEN split_part(id, '-', 4) END AS INTEGER) AS n FROM boe_sumario")
def try_int(spark, d):
    return table(spark, d, "boe_sumario").select("id", X.try_int(F.split("id", "-")[3]).alias("n"))


@query("WITH g AS (SELECT id, max(organismo) AS organismo FROM ayuda GROUP BY id) SELECT id, CASE WHEN substr(id, length(id), 1) = '1' THEN 'Cambiado' ELSE organismo END AS organismo, CASE WHEN substr(id, length(id), 1) = '1' THEN 1 ELSE 0 END::INTEGER AS cambios FROM g WHERE substr(id, length(id), 1) <> '0'")
def review_apply(spark, d):
    from pliego.operators.review import apply_reviews

    gold = table(spark, d, "ayuda").groupBy("id").agg(F.max("organismo").alias("organismo")).select("id", F.lit("ayuda").alias("tipo"), F.to_json(F.struct("organismo"), {"ignoreNullFields": "false"}).alias("json"), F.lit(False).alias("descartado"))
    last = F.substring("id", -1, 1)
    reviews = gold.select(F.when(last == "0", "descartar").when(last == "1", "aceptada").otherwise("rechazada").alias("decision"), F.array("id").alias("ids"), F.lit(1).alias("n"), F.lit('{"organismo": "Cambiado"}').alias("cambios"))
    return apply_reviews(gold, reviews).select("id", F.get_json_object("json", "$.organismo").alias("organismo"), F.size("revision").alias("cambios"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Candidates by kind with their extracted amounts: scan, classification, join, extraction, aggregation."""
    found = C.classify(table(spark, d, "boe_sumario")).select("id", "tipo", "subtipo").distinct()
    x = found.join(docs(spark, d).select("id", "texto"), "id", "left")
    return x.groupBy("tipo", "subtipo").agg(F.count(F.lit(1)).alias("n"), F.count("texto").alias("con_texto"), F.round(F.sum(N.amount(F.col("texto"))), 2).alias("total_eur")).orderBy("tipo", "subtipo")
