"""Records against a contract: violations compiled from a schema into column expressions over VARIANT."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VIOLATIONS = "array<struct<location:string,message:string>>"
#: How types of a schema show in the schema of a variant.
SHOWN = {"null": "^VOID$", "string": "^STRING$", "boolean": "^BOOLEAN$", "integer": "^BIGINT$|^DECIMAL\\(\\d+,0\\)$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "array": "^ARRAY<", "object": "^OBJECT<"}


def compiled(schema: dict) -> Callable[[Column, Column], Column]:
    """``check(value, place)``: the violations of a variant by ``schema``, as an array of (location, message).

    Known words: ``type`` (one or several), ``enum``, ``minimum``, ``maximum``, ``required``, ``properties``, ``additionalProperties`` (false) and
    ``items``. A member that is there with a null is told from one that is missing.
    """
    types = schema.get("type", [])
    types = [types] if isinstance(types, str) else types
    members = {name: compiled(s) for name, s in schema.get("properties", {}).items()}
    items = compiled(schema["items"]) if "items" in schema else None

    def check(value: Column, place: Column) -> Column:
        shown = F.schema_of_variant(value)
        is_ = lambda t: shown.rlike(SHOWN[t])
        at = F.when(place == "", "(root)").otherwise(place)
        tell = lambda on, what: F.when(on, F.struct(at.alias("location"), what.alias("message")))
        flat, nested = [], []
        if types:
            fits = is_(types[0])
            for t in types[1:]:
                fits = fits | is_(t)
            flat.append(tell(~fits, F.lit("is no " + " or ".join(types))))
        if "enum" in schema:
            text = F.try_variant_get(value, "$", "string")
            known = text.isin(*[v for v in schema["enum"] if v is not None]) & is_("string")
            allowed = known | is_("null") if None in schema["enum"] else known
            flat.append(tell(~F.coalesce(allowed, F.lit(False)), F.lit("is none of the known values")))
        number = F.try_variant_get(value, "$", "double")
        if "minimum" in schema:
            flat.append(tell(is_("number") & (number < schema["minimum"]), F.lit(f"is below {schema['minimum']}")))
        if "maximum" in schema:
            flat.append(tell(is_("number") & (number > schema["maximum"]), F.lit(f"is above {schema['maximum']}")))
        keys = F.when(is_("object"), F.json_object_keys(F.to_json(value)))
        for name in schema.get("required", []):
            flat.append(tell(is_("object") & ~F.array_contains(keys, name), F.lit(f"lacks {name}")))
        if schema.get("additionalProperties") is False:
            others = F.array_sort(F.array_except(keys, F.array(*[F.lit(n) for n in members]) if members else F.array().cast("array<string>")))
            flat.append(tell(F.size(others) > 0, F.concat(F.lit("has unknown "), F.array_join(others, ", "))))
        for name, inner in members.items():
            down = F.when(place == "", F.lit(name)).otherwise(F.concat(place, F.lit(f"/{name}")))
            nested.append(F.when(is_("object") & F.array_contains(keys, name), inner(F.try_variant_get(value, f"$.{name}", "variant"), down)))
        if items:
            each = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda v, k: items(v, F.concat_ws("/", place, k.cast("string"))))
            nested.append(F.when(is_("array"), F.flatten(each)))
        found = F.array_compact(F.array(*flat)).cast(VIOLATIONS) if flat else F.array().cast(VIOLATIONS)
        none = F.array().cast(VIOLATIONS)
        return F.concat(found, *[F.coalesce(n.cast(VIOLATIONS), none) for n in nested])

    return check


def violations(records: DataFrame, schema: dict, column: str = "record") -> DataFrame:
    """``records`` with ``violations`` of their JSON text ``column``, sorted by place; text that does not parse breaks the contract itself."""
    value = F.try_parse_json(F.col(column))
    broken = F.array(F.struct(F.lit("(root)").alias("location"), F.lit("is no JSON").alias("message"))).cast(VIOLATIONS)
    rows = records.withColumn("_value", value)
    found = F.when(F.col("_value").isNull(), broken).otherwise(F.array_sort(compiled(schema)(F.col("_value"), F.lit(""))))
    return rows.withColumn("violations", found).drop("_value")


def members(decoded: DataFrame) -> Column:
    """A decoded row's fields that the contract knows; not validated unless it says so."""
    names = [c for c in RECORD["properties"] if c in decoded.columns]
    return F.struct(*names, *([] if "validated" in names else [F.lit(False).alias("validated")]))


def record(decoded: DataFrame) -> Column:
    """A decoded row as the JSON text of its record: the fields that the contract knows, unknown ones with a null, not validated."""
    return F.to_json(members(decoded), {"ignoreNullFields": "false"})


#: How values of Spark's types show in JSON, as types of a schema.
SHOWN_AS = {"void": (), "string": ("string",), "boolean": ("boolean",), "byte": ("integer", "number"), "short": ("integer", "number"), "integer": ("integer", "number"), "long": ("integer", "number"), "double": ("number",), "struct": ("object",)}


def settled(schema: dict, kind: T.DataType, value: Column, place: str = "") -> list[Column] | None:
    """The violations that ``violations`` finds in the JSON of a typed ``value``, each null where it is none, without that JSON.

    What the type rules out makes no column. None if JSON alone can tell: for other types, texts of numbers and items.
    """
    types, name, at = schema.get("type", []), kind.typeName(), place or "(root)"
    types, double = [types] if isinstance(types, str) else types, name == "double"
    if name not in SHOWN_AS or "items" in schema and name != "void" or double and ("enum" in schema or "integer" in types) or "enum" in schema and name not in ("string", "void"):
        return None
    tell = lambda on, what: F.when(on, F.struct(F.lit(at).alias("location"), F.lit(what).alias("message")))
    there, gone, found = value.isNotNull(), value.isNull(), []
    # JSON has no such numbers: they are written as texts
    finite = there & ~value.isin(float("nan"), float("inf"), float("-inf")) if double else there
    if types:
        wrong = [] if "null" in types else [gone]
        if double:
            wrong += [finite] * ("number" not in types) + [there & ~finite] * ("string" not in types)
        elif not set(types) & set(SHOWN_AS[name]):
            wrong.append(there)
        if wrong:
            found.append(tell(reduce(or_, wrong), "is no " + " or ".join(types)))
    if "enum" in schema:
        known = value.isin(*[v for v in schema["enum"] if v is not None]) if name == "string" else F.lit(None).cast("boolean")
        found.append(tell(~F.coalesce(known, F.lit(None in schema["enum"])), "is none of the known values"))
    if "number" in SHOWN_AS[name]:
        found += [tell(finite & (value < schema["minimum"]), f"is below {schema['minimum']}")] if "minimum" in schema else []
        found += [tell(finite & (value > schema["maximum"]), f"is above {schema['maximum']}")] if "maximum" in schema else []
    if name == "struct":
        members = schema.get("properties", {})
        found += [tell(there, f"lacks {m}") for m in schema.get("required", []) if m not in kind.names]
        others = sorted(set(kind.names) - set(members))
        if others and schema.get("additionalProperties") is False:
            found.append(tell(there, "has unknown " + ", ".join(others)))
        for m in kind.names:
            inner = settled(members.get(m, {}), kind[m].dataType, value[m], f"{place}/{m}".lstrip("/")) if m in members else []
            if inner is None:
                return None
            found += [F.when(there, x) for x in inner]
    return found


def record_violations(decoded: DataFrame) -> DataFrame:
    """``decoded`` with the ``violations`` of each row's ``record``: from types and values where they settle it, else from its JSON."""
    whole = members(decoded)
    found = settled(RECORD, decoded.select(whole.alias("r")).schema["r"].dataType, whole)
    if found is None:
        return violations(decoded.withColumn("record", record(decoded)), RECORD).drop("record")
    return decoded.withColumn("violations", F.array_sort(F.array_compact(F.array(*found))).cast(VIOLATIONS))


def _maybe(kind: str, **more) -> dict:
    return {"type": [kind, "null"], **more}


# Names, types and known values of a decoded record.
RECORD = {
    "type": "object",
    "additionalProperties": False,
    "required": ["raw_label", "source_type", "confidence", "validated"],
    "properties": {
        "raw_label": {"type": "string"},
        "source_type": {"type": "string", "enum": ["kiona", "bacnet", "other"]},
        "carrier": _maybe("string", enum=["el", "fjernvarme", "kjoling", "gass", "vann", "annet", None]),
        "function": _maybe("string"),
        "measurement_type": _maybe("string", enum=["energi", "effekt", "temperatur", "volum", "trykk", "kostnad", "co2", "status", "kommando", "annet", None]),
        "unit": _maybe("string"),
        "object_type": _maybe("string", enum=["AV", "BV", "MV", "AI", "AO", "BI", "BO", "MI", "MO", None]),
        "primary_system": _maybe("object", additionalProperties=False, required=["code"], properties={"code": {"type": "string"}, "description": {"type": "string"}}),
        "subsystem": _maybe("string"),
        "component": _maybe("string"),
        "location": _maybe("object", additionalProperties=False, required=["building", "zone"], properties={"building": _maybe("string"), "zone": _maybe("string")}),
        "is_derived": _maybe("boolean"),
        "confidence": {"type": "number", "minimum": 0, "maximum": 1},
        "reasoning": _maybe("string"),
        "data_checks": _maybe("object", additionalProperties=False, properties={"temp_correlation": _maybe("number"), "distinct_values": _maybe("integer"), "monotonic": _maybe("boolean"), "conflict": _maybe("boolean")}),
        "relationships": {"type": "array", "items": {"type": "object", "additionalProperties": False, "required": ["type", "target_raw_label"], "properties": {"type": {"type": "string"}, "target_raw_label": {"type": "string"}}}},
        "validated": {"type": "boolean"},
        "decode_method": _maybe("string", enum=["rules", "retrieval", "rules+retrieval", "llm", "rules+llm", "retrieval+llm", "rules+retrieval+llm", "human", None]),
        "decoded_kb_version": _maybe("string"),
    },
}
