"""Schemas, closed vocabularies and field lists."""

from __future__ import annotations

from pyspark.sql import types as T

TERM = "struct<dias:int,tipo:string,desde:string,fecha_fin:date>"
#: Typed payload of each kind of document; names and order are the published format (fixed values).
PAYLOAD = {
    "convocatoria": f"organismo string, puesto string, vinculo string, plazas array<struct<turno:string,numero:int>>, sistema string, plazo_solicitudes {TERM}, titulacion string, tasa_eur double, boletin_bases string",
    "ayuda": f"organismo string, objeto string, beneficiarios string, cuantia_total_eur double, importe_max_beneficiario_eur double, plazo_solicitudes {TERM}, regimen string, bdns_id string, bases_reguladoras string",
    "licitacion": "organo_contratacion string, objeto string, tipo_contrato string, procedimiento string, valor_estimado_eur double, presupuesto_base_eur double, fecha_limite_ofertas date, lugar_ejecucion_nuts string, cpv array<string>, duracion_meses int, lotes int",
}
REQUIRED = {"convocatoria": ("organismo",), "ayuda": ("organismo",), "licitacion": ("organo_contratacion", "objeto")}
ENUMS = {
    "vinculo": ("funcionario", "laboral", "estatutario", "docente_universitario", "otro"), "sistema": ("oposicion", "concurso", "concurso_oposicion"), "turno": ("libre", "promocion_interna", "discapacidad", "otro"),
    "regimen": ("concurrencia_competitiva", "concesion_directa", "otro"), "tipo_contrato": ("obras", "servicios", "suministros", "concesion_servicios", "concesion_obras", "mixto", "otro"),
    "procedimiento": ("abierto", "abierto_simplificado", "restringido", "negociado", "dialogo_competitivo", "otro"), "tipo": ("habiles", "naturales"), "desde": ("publicacion_boe", "publicacion_diario_autonomico", "publicacion_boletin_provincial", "otro"),
}
#: Field classes of the evaluation.
TEXT = {"organismo", "puesto", "titulacion", "boletin_bases", "objeto", "beneficiarios", "bases_reguladoras", "organo_contratacion"}
LISTS = {"cpv", "plazas"}
FREE = {"objeto", "beneficiarios"}
LITERAL = TEXT | {"cpv", "lugar_ejecucion_nuts", "bdns_id"}
AMOUNTS = {"tasa_eur", "cuantia_total_eur", "importe_max_beneficiario_eur", "valor_estimado_eur", "presupuesto_base_eur"}

SUMMARY = "id string, fecha date, diario_numero int, seccion string, seccion_nombre string, departamento_codigo string, departamento string, epigrafe string, titulo string, pagina_inicial int, pagina_final int, pdf_kb int, url_pdf string, url_html string, url_xml string"


def struct(tipo: str) -> T.StructType:
    return T._parse_datatype_string(PAYLOAD[tipo])


def kinds(tipo: str) -> dict[str, str]:
    """The type of each dotted path of a payload: structs are opened, lists aren't."""
    out = {}
    for name, kind in (part.split(" ", 1) for part in PAYLOAD[tipo].split(", ")):
        if kind.startswith("struct<"):
            out |= {f"{name}.{n}": k for n, k in (x.split(":") for x in kind[len("struct<") : -1].split(","))}
        else:
            out[name] = kind
    return out


def fields(tipo: str) -> list[str]:
    return list(kinds(tipo))


def json_schema(tipo: str) -> dict:
    """The payload as a closed JSON Schema."""

    def of(name: str, t: T.DataType) -> dict:
        if isinstance(t, T.StructType):
            return {"type": "object", "additionalProperties": False, "properties": {f.name: of(f.name, f.dataType) for f in t.fields}}
        if isinstance(t, T.ArrayType):
            return {"type": "array", "items": of(name, t.elementType)}
        kind = {"string": "string", "int": "integer", "double": "number", "date": "string"}[t.simpleString()]
        return {"type": kind} | ({"enum": list(ENUMS[name])} if name in ENUMS else {}) | ({"format": "date"} if t.simpleString() == "date" else {})

    return of("", struct(tipo)) | {"required": list(REQUIRED[tipo]), "title": tipo}


def empty(tipo: str) -> dict:
    """A payload without values: lists are empty, all else is null."""
    return {name: [] if kind.startswith("array") else None for name, kind in (part.split(" ", 1) for part in PAYLOAD[tipo].split(", "))}
