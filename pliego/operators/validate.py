"""Validation of payloads against the closed schemas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pliego.schemas import ENUMS, PAYLOAD, REQUIRED, struct


def _type_ok(js: Column, path: str, t: T.DataType) -> Column:
    """Whether the value at a path is null, missing or of the type: numbers as numbers, text as text."""
    v = F.get_json_object(js, path)
    if isinstance(t, (T.IntegerType, T.DoubleType)):
        return v.isNull() | v.try_cast("double").isNotNull()
    if isinstance(t, T.DateType):
        return v.isNull() | F.try_to_date(v, "yyyy-MM-dd").isNotNull()
    return F.lit(True)


def errors(tipo: Column, js: Column) -> Column:
    """json, extra_forbidden, missing, enum or type; null for a valid payload.  A null payload, tipo or one of another kind is json."""
    out = F.lit("json")
    for kind in PAYLOAD:
        s = struct(kind)
        keys = F.json_object_keys(js)
        rules = [
            (keys.isNull(), "json"),
            (F.size(F.array_except(keys, F.array(*[F.lit(f.name) for f in s.fields]))) > 0, "extra_forbidden"),
            *[(F.get_json_object(js, f"$.{r}").isNull(), "missing") for r in REQUIRED[kind]],
            *[(~F.coalesce(F.get_json_object(js, f"$.{f.name}").isin(*ENUMS[f.name]), F.lit(True)), "enum") for f in s.fields if f.name in ENUMS],
        ]
        for f in s.fields:
            if isinstance(f.dataType, T.StructType):
                inner = F.json_object_keys(F.get_json_object(js, f"$.{f.name}"))
                rules.append((F.size(F.array_except(inner, F.array(*[F.lit(g.name) for g in f.dataType.fields]))) > 0, "extra_forbidden"))
                rules += [(~F.coalesce(F.get_json_object(js, f"$.{f.name}.{g.name}").isin(*ENUMS[g.name]), F.lit(True)), "enum") for g in f.dataType.fields if g.name in ENUMS]
                rules += [(~_type_ok(js, f"$.{f.name}.{g.name}", g.dataType), "type") for g in f.dataType.fields]
            else:
                rules.append((~_type_ok(js, f"$.{f.name}", f.dataType), "type"))
        if kind == "convocatoria":
            turns = F.from_json(F.get_json_object(js, "$.plazas"), "array<struct<turno:string,numero:int>>")
            rules.append((F.coalesce(F.exists(turns, lambda p: ~F.coalesce(p["turno"].isin(*ENUMS["turno"]), F.lit(False))), F.lit(False)), "enum"))
        case = F.when(*rules[0])
        for rule in rules[1:]:
            case = case.when(*rule)
        out = F.when(tipo == kind, case).otherwise(out)
    return out


def payload(tipo: str, js: Column) -> Column:
    """The typed payload, null where it isn't valid; missing lists are empty."""
    made = F.from_json(js, struct(tipo), {"dateFormat": "yyyy-MM-dd"})
    for f in struct(tipo).fields:
        if isinstance(f.dataType, T.ArrayType):
            made = made.withField(f.name, F.coalesce(made[f.name], F.array().cast(f.dataType)))
    return F.when(errors(F.lit(tipo), js).isNull(), made)
