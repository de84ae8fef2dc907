"""Tokens of point labels ``node:controller/path.of.segments.#tag`` as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The label grammar.
CONTROLLER = r"^(\d{8})-([\w-]+)$"
SYSTEM_TOKEN = r"^(?:[A-Z]{1,2})?(\d{5,7})(?:_(bygg\w+))?$"
EQUIPMENT_TOKEN = r"^(?:[A-Z]{1,3}\d{3}(?:_\w+)?|[A-Za-z]+pumpe_P\d+)$"
POINT_CODE = r"^-?([A-Z]{2})(\d)(\d{1,2})$"
EMBEDDED_TAIL = r"[-_ ]([A-Z]{2}\d{2,3})$"
MODBUS_TOKEN = r"^([0-9x]{3,5})_adr(\d+)$"
BYGG_ETG = r"(?i)\b(bygg\d+)(etg\d+)?\b"
SETPOINT_SUFFIX = r"_(?:SP|WSP)$"
IO_POINT = r"^(AV|BV|MV|AI|AO|BI|BO|MI|MO)-?(\d+)$"
COMBINED = r"^(\d{3})_(\d{3})_([A-Z]{2})(\d{2,3})$"
ROOM = r"(?i)\bRom (\d+-\d+)\b"
PATH_OBJECTS = {
    "analoge innganger": "AI",
    "analoge utganger": "AO",
    "analoge verdier": "AV",
    "binaere innganger": "BI",
    "binaere utganger": "BO",
    "binære innganger": "BI",
    "binære utganger": "BO",
}


def group(text: Column, pattern: str, n: int) -> Column:
    """Capture ``n``, null without a match or where the group is empty."""
    return F.nullif(F.regexp_extract(text, pattern, n), F.lit(""))


def after(text: Column, mark: str) -> Column:
    """What follows the first ``mark``; the text itself where there is none."""
    at = F.instr(text, mark)
    return F.when(at > 0, F.substr(text, at + 1, F.length(text))).otherwise(text)


def segments(label: Column) -> Column:
    return F.filter(F.transform(F.split(after(after(label, ":"), "/"), r"\."), lambda s: F.trim(s)), lambda s: (s != "") & ~s.startswith("#"))


def first_of(items: Column, pattern: str) -> Column:
    return F.get(F.filter(items, lambda s: s.rlike(pattern)), F.lit(0))


def controller(label: Column) -> Column:
    inside = F.substring_index(after(label, ":"), "/", 1)
    return F.when(F.instr(label, ":") > 0, inside)


def point_token(segs: Column) -> Column:
    """``(token, suffix)`` of the last segment that holds a component or I/O point; null if none does."""

    def parsed(s: Column) -> Column:
        suffix = group(s, f"({SETPOINT_SUFFIX})", 1)
        core = F.regexp_replace(s, SETPOINT_SUFFIX, "")
        token = F.when(core.rlike(POINT_CODE) | F.ltrim(core, F.lit("-")).rlike(IO_POINT), core).otherwise(group(core, EMBEDDED_TAIL, 1))
        return F.struct(token.alias("token"), suffix.alias("suffix"))

    return F.get(F.filter(F.transform(F.reverse(segs), parsed), lambda p: p["token"].isNotNull()), F.lit(0))


def object_type(segs: Column) -> Column:
    named = F.create_map(*[F.lit(x) for kv in PATH_OBJECTS.items() for x in kv])
    by_path = F.get(F.filter(F.transform(segs, lambda s: named[F.lower(s)]), lambda x: x.isNotNull()), F.lit(0))
    return F.coalesce(by_path, group(first_of(F.transform(F.reverse(segs), lambda s: F.ltrim(s, F.lit("-"))), IO_POINT), IO_POINT, 1))


def group_keys(label: Column, segs: Column) -> Column:
    """Array of ``(kind, key)``: what a label shares with others by its structure; each once."""
    number, rest = group(controller(label), CONTROLLER, 1), group(controller(label), CONTROLLER, 2)
    make = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.alias("key"))
    own = F.array(F.when(number.isNotNull() & rest.isNotNull(), make("same_controller", F.concat_ws("-", number, rest))))
    each = F.transform(
        segs,
        lambda s, i: F.when(s.rlike(SYSTEM_TOKEN), make("same_system", s))
        .when(s.rlike(EQUIPMENT_TOKEN), make("same_equipment", s))
        .when(s.rlike(MODBUS_TOKEN) & (i > 0), make("same_equipment", F.concat_ws(".", F.get(segs, i - 1), s))),
    )
    return F.array_distinct(F.array_compact(F.concat(own, each)))


def point_role(label: Column) -> Column:
    """``(letters, side)`` of the first two-letter code with exactly three digits."""
    parts = F.transform(F.split(after(label, ":"), r"\."), lambda s: F.trim(s))
    code = first_of(parts, r"^-?[A-Z]{2}\d{3}$")
    return F.struct(group(code, POINT_CODE, 1).alias("letters"), group(code, POINT_CODE, 2).alias("side"))


def signature(label: Column) -> Column:
    """Digit runs as ``#``, lower case: labels of one family share it."""
    return F.lower(F.regexp_replace(label, r"\d+", "#"))


def point_name(label: Column) -> Column:
    return F.coalesce(F.get(segments(label), F.size(segments(label)) - 1), label)


def code_prefix(code: Column, n: int = 3) -> Column:
    return F.nullif(F.substring(F.regexp_extract(F.trim(code), r"^\d+", 0), 1, n), F.lit(""))


def normal_text(text: Column) -> Column:
    """For comparing: composed letters, full case folding (``ß`` is ``ss``), single spaces, trimmed; accents stay.

    ASCII, where folding is lower case, never leaves the JVM.
    """

    def folding(text: pd.Series) -> pd.Series:
        return text.str.normalize("NFC").str.casefold()

    plain = text.rlike(r"^[\x00-\x7F]*$")
    folded = F.when(plain, F.lower(text)).otherwise(F.pandas_udf(folding, T.StringType())(F.when(~plain, text)))
    return F.trim(F.regexp_replace(folded, r"\s+", " "))


def control_numbers(name: Column) -> Column:
    return F.regexp_extract_all(name, F.lit(r"(?<!\d)\d{8}(?!\d)"), F.lit(0))


def iso_date(text: Column) -> Column:
    """``YYYY-MM-DD`` of an ISO or ``DD/MM/YYYY`` text, else null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(text, 1, 10)).when(text.rlike(r"^\d{2}/\d{2}/\d{4}"), F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2)))


def iri_name(text: Column) -> Column:
    """A name safe in an IRI; where characters were lost, with a digest of the text."""
    safe = F.regexp_replace(text, r"[^A-Za-z0-9_.-]", "_")
    return F.when(safe == text, safe).otherwise(F.concat(safe, F.lit("_"), F.substring(F.sha1(text), 1, 6)))


def point_id(label: Column) -> Column:
    return F.substring(F.sha1(label), 1, 12)


def with_tokens(labels: DataFrame, col: str = "raw_label") -> DataFrame:
    """Adds every token of ``col``."""
    x = F.col(col)
    out = labels.withColumn("segs", segments(x))
    system, point = first_of(F.col("segs"), SYSTEM_TOKEN), F.col("_point")
    out = out.withColumns({"_point": point_token(F.col("segs")), "_role": point_role(x), "combined": first_of(F.col("segs"), COMBINED)})
    return out.withColumns(
        {
            "control_number": group(controller(x), CONTROLLER, 1),
            "controller_rest": group(controller(x), CONTROLLER, 2),
            "system_digits": group(system, SYSTEM_TOKEN, 1),
            "bygg": group(system, SYSTEM_TOKEN, 2),
            "point_token": point["token"],
            "point_suffix": point["suffix"],
            "bygg_alone": group(x, BYGG_ETG, 1),
            "etg": group(x, BYGG_ETG, 2),
            "role_letters": F.col("_role.letters"),
            "role_side": F.col("_role.side"),
            "io_type": object_type(F.col("segs")),
            "room": group(x, ROOM, 1),
        }
    ).drop("_point", "_role")
