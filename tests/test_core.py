"""Core operators on small literals, and every query against its SQL."""

import datetime
import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pliego import schemas
from pliego.functions import normalize as N
from pliego.functions import text as X
from pliego.operators import classify, conventions, corpus, evaluate, report, review, rules, sampling, validate
from pliego.plans.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


def one(spark, values, expr, schema="a string"):
    df = spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_amounts(spark):
    got = one(spark, ["por 1.234.567,89 euros", "(9.500 €)", "2.000.000 de euros", "41,70 euros", "nada", None, "1.234.5 euros"], N.amount(F.col("a")))
    assert got == [1234567.89, 9500.0, 2000000.0, 41.7, None, None, 5.0]


def test_number_words(spark):
    assert one(spark, ["Seis", "treinta y uno", "cincuenta", "27", "mil", "treinta y diez", "veintidos", None], N.number(F.col("a"))) == [6, 31, 50, 27, None, 40, None, None]


def test_dates(spark):
    x = ["el 3 de Mayo de 2026", "31 de febrero de 2026", "sin fecha", None]
    assert one(spark, x, N.date(F.col("a"))) == [datetime.date(2026, 5, 3), None, None, None]
    assert one(spark, x, N.impossible_date(F.col("a"))) == [False, True, False, False]


def test_deadlines(spark):
    x = ["de veinte días hábiles desde su publicación en el «Boletín Oficial del Estado»", "15 días naturales, Boletín Oficial de la Provincia", "cuarenta y cinco días naturales", "un mes"]
    got = one(spark, x, N.deadline(F.col("a")))
    assert [(g and (g.dias, g.tipo, g.desde)) for g in got] == [(20, "habiles", "publicacion_boe"), (15, "naturales", "publicacion_boletin_provincial"), (45, "naturales", None), None]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(0, 10**9), min_size=1, max_size=20))
def test_amount_round_trip(spark, cents):
    texts = [f"{c // 100:,}".replace(",", ".") + f",{c % 100:02d} euros" for c in cents]
    assert one(spark, texts, N.amount(F.col("a"))) == [c // 100 + (c % 100) / 100 if False else float(f"{c // 100}.{c % 100:02d}") for c in cents]


def test_case_and_format(spark):
    assert one(spark, ["D'ART (sevilla)", None], X.title_case(F.col("a"))) == ["D'Art (Sevilla)", None]
    assert one(spark, ["MINISTERIO DE LA MAR"], X.title_case_es(F.col("a"))) == ["Ministerio de la Mar"]
    assert one(spark, ["  CONSEJO DEL AGUA, ", "ABC", "Mixto,"], X.format_string(F.col("a"))) == ["Consejo del Agua", "ABC", "Mixto"]
    assert one(spark, ['<a & "b">\''], X.html_escape(F.col("a"))) == ["&lt;a &amp; &quot;b&quot;&gt;&#x27;"]


def test_windows_and_labels(spark):
    assert one(spark, ["xx CUANTÍA total", "nada"], X.window_after(F.col("a"), "cuant[ií]a", 4)) == [" tot", ""]
    assert one(spark, ["5. Valor estimado (IVA):\n  12 euros.\n"], X.label_line(F.col("a"), "Valor estimado")) == ["12 euros"]
    assert one(spark, ["Segundo. Objeto: Uno\nDos", "Segundo. Objeto:\nDos\n", "nada"], X.section(F.col("a"), "Objeto")) == ["Uno", "Dos", None]
    assert one(spark, ["un concurso-oposición", "oposición y concurso", ""], X.first_match(F.col("a"), rules.SYSTEM)) == ["concurso_oposicion", "oposicion", None]


def test_tokens(spark):
    assert one(spark, ["Año más,  NIÑO", None], X.tokens(F.col("a"))) == [["ano", "mas", "nino"], []]
    got = one(spark, [("Ayuntamiento de Alba", "ayuntamiento"), ("", ""), ("a b", "A B")], X.token_f1(F.col("a"), F.col("b")), "a string, b string")
    assert got == [0.5, 0.0, 1.0]


def test_fold_is_unicode(spark):
    """Case folding and compatibility decomposition, on every assigned character of the first two planes."""
    import unicodedata

    known = [chr(c) for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    texts = ["".join(known[k : k + 300]) for k in range(0, len(known), 300)] + ["n.º 1ª ﬁn Straße ½ İ", ""]
    want = ["".join(c for c in unicodedata.normalize("NFKD", t.casefold()) if not unicodedata.combining(c)) for t in texts]
    got = spark.createDataFrame(list(enumerate(texts)), "k int, a string").select("k", X.fold(F.col("a"))).collect()
    assert [r[1] for r in sorted(got)] == want
    assert one(spark, ["n.º 1ª", None], X.tokens(F.col("a"))) == [["n", "o", "1a"], []]


def test_truncate(spark):
    assert one(spark, ["uno, dos  tres", "uno", "", None, "a b c d e "], X.truncate_tokens(F.col("a"), 3)) == ["uno, dos", "uno", "", None, "a b c"]


def test_whole_evaluation(spark):
    """Two tenders of which one has a prediction, by hand; and the populations of them."""
    shape = "id string, " + schemas.PAYLOAD["licitacion"]
    row = lambda i: (i, "Junta", "Obra", None, "abierto", None, None, None, None, ["1"], None, None)
    gold = {t: spark.createDataFrame([row("a"), row("b")] if t == "licitacion" else [], shape if t == "licitacion" else f"id string, {schemas.PAYLOAD[t]}") for t in schemas.PAYLOAD}
    said = spark.createDataFrame([("a", json.dumps({"organo_contratacion": "Junta", "objeto": "Obra", "procedimiento": "abierto", "cpv": ["1"], "valor_estimado_eur": 5.5}), True, True), ("b", "{", False, False)], "id string, json string, valido boolean, sin_prellenado boolean")
    texts = spark.createDataFrame([("a", "La Junta licita la obra; CPV 1; 5,50 euros"), ("b", None)], "id string, texto string")
    rows = evaluate.evaluation(gold, said, texts)
    got = {(r.id, r.campo): (r.tp, r.fp, r.fn, r.alucinado) for r in rows.collect()}
    assert len(got) == 22 and got["a", "procedimiento"] == (1, 0, 0, None) and got["b", "procedimiento"] == (0, 0, 1, None) and got["a", "cpv"] == (1, 0, 0, False)
    assert got["a", "valor_estimado_eur"] == (0, 1, 0, False) and got["a", "lotes"] == (0, 0, 0, None) and got["a", "objeto"][3] is False
    p = {r.poblacion: r for r in evaluate.populations(rows).collect()}
    assert set(p) == {"todo", "licitacion", "sin_prellenado"} and p["todo"].documentos == 2 and p["todo"].validos == 0.5 and p["sin_prellenado"].validos == 1
    assert abs(p["todo"].micro - 6 / (6 + 1 + 3)) < 1e-9 and abs(p["todo"].texto_libre - 2 / 3) < 1e-9 and p["todo"].alucinacion == 0


def test_queue_and_strictness(spark):
    r = [(f"BOE-{k % 7}-{k:03}", "x" if k % 3 else None, "abc"[k % 2]) for k in range(60)]
    df = spark.createDataFrame(r, "id string, tipo string, grupo string")
    got = {x.id: x.orden for x in sampling.queued(df, "tipo", "grupo", "id", "orden", bucket=5).collect()}
    for t in ("x", None):
        assert [got[i] for _, i in sorted((g, i) for i, tt, g in r if tt == t)] == list(range(1, 1 + sum(tt == t for _, tt, _ in r)))
    assert sampling.matched(df.limit(3), df).count() == 3
    with pytest.raises(KeyError):
        sampling.matched(spark.createDataFrame([("no",)], "id string"), df)
    with pytest.raises(ValueError):
        review.pending_decisions(spark.createDataFrame([(1, "aceptada"), (2, None)], "n int, decision string"))
    review.pending_decisions(spark.createDataFrame([(1, "aceptada")], "n int, decision string"))
    assert schemas.empty("convocatoria")["plazas"] == [] and schemas.empty("ayuda")["plazo_solicitudes"] is None


def test_rules_are_validated(spark):
    df = spark.createDataFrame([("1", "licitacion", None, "T", "D", "5. Plazo para la recepción de ofertas:\nHasta el 31 de febrero de 2026"), ("2", "licitacion", None, "T", "D", "5. Plazo para la recepción de ofertas:\nHasta el 3 de febrero de 2026"), ("3", "licitacion", None, "T", None, ""), ("4", "otro", None, "T", "D", "x")], "id string, tipo string, subtipo string, titulo string, departamento string, texto string")
    assert {r.id: r.valido for r in rules.extract(df).collect()} == {"1": False, "2": True, "3": False, "4": False}


@pytest.mark.parametrize(
    ("section", "epigraph", "title", "kind", "sub"),
    [
        ("2B", "Personal", "Resolución, por la que se convoca proceso selectivo", "convocatoria", "bases"),
        ("2B", "Personal", "Resolución del Ayuntamiento de X, referente a la convocatoria para proveer", "convocatoria", "anuncio_local"),
        ("2B", None, "Resolución, por la que se convoca proceso selectivo", None, None),
        ("2B", "Personal", "Resolución, por la que se convoca plaza del tribunal", None, None),
        ("2B", classify.FREE_EPIGRAPH, "Orden por la que se convoca puesto", None, None),
        ("5B", None, "Extracto de la Orden por la que se convocan ayudas", "ayuda", None),
        ("5B", None, "Extracto: se amplía el plazo; convoca", None, None),
        ("3", None, "Orden por la que se convoca el premio", "ayuda", None),
        ("3", None, "Orden por la que se convoca jurado del premio", None, None),
        ("5A", None, "Anuncio de licitación de: X", "licitacion", None),
        ("5A", None, "Corrección de errores. Anuncio de licitación", None, None),
        (None, None, "Anuncio de licitación de: X", None, None),
    ],
)
def test_classify(spark, section, epigraph, title, kind, sub):
    df = spark.createDataFrame([(section, epigraph, title)], "seccion string, epigrafe string, titulo string")
    t = classify.tipo(df.titulo, df.seccion, df.epigrafe)
    assert tuple(df.select(t, classify.subtipo(t, df.titulo)).first()) == (kind, sub)


def test_rules_on_empty_and_template(spark):
    text = "1.1) Nombre:\nConsejo X.\n4. Tipo de procedimiento:\nAbierto simplificado.\n5. Valor estimado:\n1.000,50 euros.\n9. CPV principal:\n12345678, 12345678.\n7. Duración del contrato:\n18 meses.\nLote 1: a\nLote 12: b\n2. Lugar de ejecución:\nES300\n"
    df = spark.createDataFrame([("1", "licitacion", None, "T", "DEP", text), ("2", "licitacion", None, "T", "DEP", None), ("3", "otro", None, "T", "D", "x"), ("4", "ayuda", None, "T", "DEP", ""), ("5", "convocatoria", "bases", "T", "D", "Dos plazas de X")], "id string, tipo string, subtipo string, titulo string, departamento string, texto string")
    got = {r.id: r.json and json.loads(r.json) for r in rules.extract(df).collect()}
    a = got["1"]
    assert (a["organo_contratacion"], a["procedimiento"], a["valor_estimado_eur"], a["cpv"], a["duracion_meses"], a["lotes"], a["lugar_ejecucion_nuts"]) == ("Consejo X", "abierto_simplificado", 1000.5, ["12345678"], 18, 12, "ES300")
    assert got["2"]["organo_contratacion"] == "Dep" and got["2"]["cpv"] == [] and got["3"] is None and got["5"]["plazas"] == [{"turno": "libre", "numero": 2}]
    assert set(got["4"]) == {f.name for f in schemas.struct("ayuda").fields}


@pytest.mark.parametrize(
    ("kind", "text", "error"),
    [
        ("ayuda", '{"organismo": "X"}', None), ("ayuda", '{"organismo": "X", "regimen": "raro"}', "enum"), ("ayuda", '{"organismo": "X", "y": 1}', "extra_forbidden"), ("ayuda", '{"objeto": "X"}', "missing"),
        ("ayuda", "{", "json"), ("ayuda", None, "json"), ("otro", "{}", "json"), ("convocatoria", '{"organismo": "X", "plazas": [{"turno": "raro", "numero": 1}]}', "enum"),
        ("licitacion", '{"organo_contratacion": "X", "objeto": "Y", "lotes": "muchos"}', "type"), ("ayuda", '{"organismo": "X", "plazo_solicitudes": {"dias": 3, "z": 1}}', "extra_forbidden"),
    ],
)
def test_validate(spark, kind, text, error):
    df = spark.createDataFrame([(kind, text)], "tipo string, json string")
    assert df.select(validate.errors(df.tipo, df.json)).first()[0] == error


def test_json_schema_is_closed():
    s = schemas.json_schema("convocatoria")
    assert s["additionalProperties"] is False and s["properties"]["plazas"]["items"]["additionalProperties"] is False
    assert [len(schemas.fields(k)) for k in schemas.PAYLOAD] == [12, 12, 11]


def test_conventions(spark):
    df = spark.createDataFrame([("Proceso de ingreso", "concurso de méritos"), ("Provisión de puestos", ""), ("Otro", "concurso de méritos"), ("Otro", "concurso de méritos, turno libre")], "a string, b string")
    assert [r[0] for r in df.select(conventions.is_provision(df.a, df.b)).collect()] == [False, True, True, False]
    posts = spark.createDataFrame([([("libre", 4), ("otro", 1), ("libre", 3)],)], "p array<struct<turno:string,numero:int>>")
    assert [tuple(x) for x in posts.select(conventions.sum_turns(posts.p)).first()[0]] == [("libre", 7), ("otro", 1)]
    assert one(spark, ["Orden ABC/1/2025, de 5 de junio de 2025, y más", "otra cosa de 5 de junio"], conventions.citation(F.col("a"))) == ["Orden ABC/1/2025, de 5 de junio de 2025", "otra cosa de 5 de junio"]


def test_samples_and_split(spark):
    df = spark.createDataFrame([(f"i{k}", "a" if k % 3 else "b") for k in range(300)], "id string, g string")
    s = sampling.stratified(df, "g", {"a": 20, "b": None})
    n = {r.g: r["count"] for r in s.groupBy("g").count().collect()}
    assert n == {"a": 20, "b": 100} and sorted(s.collect()) == sorted(sampling.stratified(df, "g", {"a": 20, "b": None}).collect())
    assert sampling.flag_k(df, "g", 10, "f").filter("f").count() == 20
    ids = spark.range(2000).select(F.concat(F.lit("BOE-"), F.col("id")).alias("id"))
    assert 50 <= ids.filter(sampling.is_validation(F.col("id"))).count() <= 150
    last = sampling.latest(spark.createDataFrame([("x", 1, "a"), ("x", 3, "b"), ("y", 2, "c")], "id string, seq int, v string"), "id", "seq")
    assert sorted((r.id, r.v) for r in last.collect()) == [("x", "b"), ("y", "c")]
    assert {r.split for r in corpus.split(ids, ids.limit(3)).collect()} == {"train", "validation", "test"}


def test_counts(spark):
    df = spark.createDataFrame([(None, None), (None, "x"), ("x", None), ("uno dos", "uno")], "g string, p string")
    got = [tuple(r[0]) for r in df.select(evaluate.counts("organismo", df.g, df.p)).collect()]
    assert got[:3] == [(0, 0, 0), (0, 1, 0), (0, 0, 1)] and abs(got[3][0] - 2 / 3) < 1e-9
    c = spark.createDataFrame([(["1", "2"], ["2", "3"])], "g array<string>, p array<string>")
    assert tuple(c.select(evaluate.counts("cpv", c.g, c.p)).first()[0]) == (1, 1, 1)
    a = spark.createDataFrame([(5.0, 5.001), (5.0, 6.0)], "g double, p double")
    assert [tuple(r[0]) for r in a.select(evaluate.counts("tasa_eur", a.g, a.p)).collect()] == [(1, 0, 0), (0, 1, 1)]


def test_latency_extrapolates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 7), ("c", None)], "g string, ms int")
    got = {r.g: (r.p50, r.p95) for r in evaluate.latency(df, "ms", "g").collect()}
    assert got["a"] == (1.5, 2.85) and got["b"] == (7.0, None) and "c" not in got


def test_hallucination(spark):
    df = spark.createDataFrame([("Puente de Alba", "El puente nuevo de Alba"), ("Otra cosa rara", "nada"), (None, "x")], "v string, t string")
    assert [r[0] for r in df.select(evaluate.hallucinated_literal(df.v, df.t)).collect()] == [False, True, None]
    a = spark.createDataFrame([(1234.5, "1.234,50 euros"), (1234.5, "1.234 euros"), (99.0, "99 euros")], "v double, t string")
    assert [r[0] for r in a.select(evaluate.hallucinated_amount(a.v, a.t)).collect()] == [False, True, False]
    b = spark.createDataFrame([(datetime.date(2026, 5, 3), "el 03 de mayo de 2026"), (datetime.date(2026, 5, 3), "3/05/2026"), (datetime.date(2026, 5, 3), "no")], "v date, t string")
    assert [r[0] for r in b.select(evaluate.hallucinated_date(b.v, b.t)).collect()] == [False, False, True]


def test_review(spark):
    data = {"a": 1, "p": None, "plazas": [{"turno": "x"}, {"turno": "y"}]}
    assert review.patch(data, {"a": 2, "p.z": 3, "plazas.turno": "w"}) == {"a": 2, "p": None, "plazas": [{"turno": "w"}, {"turno": "w"}]} and data["a"] == 1
    gold = spark.createDataFrame([("1", "ayuda", "{}", False), ("2", "ayuda", "{}", False), ("3", "ayuda", "{}", True), ("4", "ayuda", "{}", None)], "id string, tipo string, json string, descartado boolean")
    rev = spark.createDataFrame([(2, ["1", "4"], '{"x": 2}', "aceptada"), (1, ["1"], '{"x": 1}', "aceptada"), (3, ["2"], "{}", "descartar"), (4, ["4"], '{"x": 9}', "rechazada")], "n int, ids array<string>, cambios string, decision string")
    got = {r.id: (json.loads(r.json), list(r.revision)) for r in review.apply_reviews(gold, rev).collect()}
    assert got == {"1": ({"x": 2}, [1, 2]), "4": ({"x": 2}, [2])}


def test_report(spark):
    p = spark.createDataFrame([((10, "habiles", None, None),), ((None, None, None, datetime.date(2026, 1, 2)),), ((0, None, None, None),), (None,)], "p struct<dias:int,tipo:string,desde:string,fecha_fin:date>")
    assert [r[0] for r in p.select(report.term(p.p)).collect()] == ["10 días hábiles", "hasta el 2026-01-02", "", ""]
    assert one(spark, [1250000.5, None], N.euros(F.col("a")), "a double") == ["1.250.000 €", ""]
    rows = spark.createDataFrame([("ayuda", "<tr><td>x</td></tr>")], "tipo string, fila string")
    page = report.page(rows, "2026-01-02", ["2025-12-30", "2026-01-01"])
    assert page.index("2026-01-01.html") < page.index("2025-12-30.html") and "<tr><td>x" in page


def test_xml(spark):
    from pliego.sources.xml import document_fields, flatten_summary

    item = lambda i, kb="3": f'<item><identificador>{i}</identificador><titulo>T &amp; {i}</titulo><url_pdf szKBytes="{kb}" pagina_inicial="1" pagina_final="x">u</url_pdf></item>'
    xml = f"<sumario><metadatos><fecha_publicacion>20260929</fecha_publicacion></metadatos><diario numero='240'><seccion codigo='2A'><departamento codigo='1'>{item('no')}</departamento></seccion><seccion><departamento codigo='2' nombre='D'>{item('b')}<epigrafe nombre='E'>{item('a')}</epigrafe></departamento></seccion></diario></sumario>"
    got = flatten_summary(spark.createDataFrame([(xml,)], "xml string"), "xml").collect()
    assert [(r.id, r.epigrafe, r.seccion, r.pagina_final, r.pdf_kb, r.titulo) for r in got] == [("a", "E", None, None, 3, "T & a"), ("b", None, None, None, 3, "T & b")]
    doc = "<documento><metadatos/><analisis><nota> a\n b </nota><nota>c</nota><x/></analisis><texto>suelto<p>uno <b>dos</b></p><dl><dt>t</dt><dd><dl><dt>n</dt></dl></dd></dl><table><tr><td/><td/></tr></table><p> </p></texto></documento>"
    assert document_fields(doc) == (None, '{"nota": ["a b", "c"]}', "uno dos\nt\nn\n | ")
    assert document_fields("<roto") == (None, None, None) == document_fields(None)


def fake_get(url):
    return None if url.endswith("404") else f"<x>{url}</x>".encode()


def test_fetch_source(spark, tmp_path):
    from pliego.sources.fetch import _Reader

    options = {"urls": "h/a.xml\nh/404", "cache": str(tmp_path), "get": "tests.test_core:fake_get" if os.path.exists("tests/__init__.py") else f"{__name__}:fake_get", "pause": "0"}
    first = list(_Reader(options).read(None))
    assert first == [("h/a.xml", "<x>h/a.xml</x>"), ("h/404", None)] == list(_Reader({**options, "get": "json:loads"}).read(None))


def test_records_and_days(spark, tmp_path):
    from pliego.sources import records

    path = str(tmp_path / "r")
    records.write_records(spark.createDataFrame([("a", None), ("b", "ñ")], "id string, v string"), path)
    assert sorted((r.id, r.v) for r in records.last_by_id(records.read_records(spark, path, "id string, v string")).collect()) == [("a", None), ("b", "ñ")]
    assert records.read_records(spark, str(tmp_path / "none"), "id string", required=False).count() == 0
    day = spark.createDataFrame([("a", "2026-01-01")], "id string, fecha string")
    assert records.write_day(day, str(tmp_path / "d"), "2026-01-01") and not records.write_day(day, str(tmp_path / "d"), "2026-01-01") and not records.write_day(day.limit(0), str(tmp_path / "d"), "2026-01-02")


def test_daily_batch_and_stream(spark, tmp_path):
    from pliego.streaming import daily

    s, b = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("boe_sumario", "boe_documents"))
    fecha = str(classify.classify(s).join(b.select("id"), "id", "left_semi").agg(F.min("fecha")).first()[0])
    out = str(tmp_path / "out")
    assert daily.run_day(spark, s, b, fecha, out) and daily.run_day(spark, s, b, fecha, out) and not daily.run_day(spark, s, b, "1999-01-01", out)
    n = spark.read.parquet(out).count()
    s.filter(F.col("fecha") == F.lit(fecha).cast("date")).write.parquet(str(tmp_path / "in"))
    daily.stream_days(spark, str(tmp_path / "in"), schemas.SUMMARY, b, str(tmp_path / "out2"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out2")).count() == n > 0
    assert json.loads(daily.extract_one(spark, "ayuda", "T", "BDNS (Identif.): 123."))["bdns_id"] == "123"
    with pytest.raises(ValueError):
        daily.extract_one(spark, "otro", "T", "x")


@pytest.mark.skipif(not os.path.exists(DATA), reason="test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_sql(spark, name):
    import duckdb

    got = QUERIES[name](spark, DATA)
    if name not in ORACLE_SQL:
        assert got.count() >= 0
        return
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DATA}/{f}'")
    r = con.execute(ORACLE_SQL[name])
    cols = [c[0] for c in r.description]

    def plain(v):
        if isinstance(v, float):
            return float(f"{v:.9g}")
        return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v

    want = sorted((tuple(plain(v) for v in row) for row in r.fetchall()), key=repr)
    assert sorted(got.columns) == sorted(cols)
    assert sorted((tuple(plain(v) for v in row) for row in got.select(*cols).collect()), key=repr) == want
