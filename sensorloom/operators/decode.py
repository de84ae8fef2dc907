"""Decoding point labels into typed records: rules as a column pipeline, then inheritance from a store of validated records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as lb
from ..sources.shared import staged
from .contract import record_violations

# What a keyword in a label's path says. Longer keywords are read first.
KEYWORDS: dict[str, dict[str, str]] = {
    "drift": {"function": "status", "measurement_type": "status"},
    "alarm": {"function": "alarm", "measurement_type": "status"},
    "alarn": {"function": "alarm", "measurement_type": "status"},
    "feil": {"function": "feil (fault)", "measurement_type": "status"},
    "modus": {"function": "modus (mode)", "measurement_type": "status"},
    "utlost_vern": {"function": "utlost vern (tripped protection)", "measurement_type": "status"},
    "utløst_vern": {"function": "utlost vern (tripped protection)", "measurement_type": "status"},
    "status": {"function": "status", "measurement_type": "status"},
    "settpunkt": {"function": "settpunkt"},
    "setpoint": {"function": "settpunkt"},
    "set point": {"function": "settpunkt"},
    "spkt": {"function": "settpunkt"},
    "borverdi": {"function": "settpunkt"},
    "børverdi": {"function": "settpunkt"},
    "temperature": {"function": "temperatur", "measurement_type": "temperatur"},
    "temperatur": {"function": "temperatur", "measurement_type": "temperatur"},
    "co2": {"function": "CO2-maaling (luftkvalitet)", "measurement_type": "co2", "unit": "ppm"},
    "kjole": {"carrier": "kjoling"},
    "kjøle": {"carrier": "kjoling"},
    "kjoling": {"carrier": "kjoling"},
    "kjøling": {"carrier": "kjoling"},
    "varme": {},
    "heating": {"system_hint": "320"},
    "spillvannspumpe": {"carrier": "vann", "component": "spillvannspumpe (pumpe)"},
    "spillvann": {"carrier": "vann"},
    "drenspumpe": {"carrier": "vann", "component": "drenspumpe (pumpe)"},
    "vannstand": {"carrier": "vann"},
    "tappevann": {"carrier": "vann"},
    "avrim": {"function": "avriming (defrost)", "measurement_type": "status"},
    "komp": {"function": "kompressor-relatert"},
    "fjernvarme": {"carrier": "fjernvarme"},
    "elkjele": {"carrier": "el"},
    "hovedtavle": {"carrier": "el"},
    "energi": {"function": "energimaaling", "measurement_type": "energi"},
    "utetemperatur": {"function": "utetemperatur", "measurement_type": "temperatur"},
    "utelufttemperatur": {"function": "utetemperatur", "measurement_type": "temperatur"},
    "swegon wise": {"system_hint": "360"},
    "h temp occ": {"function": "settpunkt (varme, tilstede)", "measurement_type": "temperatur"},
    "h temp uocc": {"function": "settpunkt (varme, ikke tilstede)", "measurement_type": "temperatur"},
    "c temp occ": {"function": "settpunkt (kjoling, tilstede)", "measurement_type": "temperatur", "carrier": "kjoling"},
    "c temp uocc": {"function": "settpunkt (kjoling, ikke tilstede)", "measurement_type": "temperatur", "carrier": "kjoling"},
    "temp natt": {"function": "settpunkt (nattsenking)", "measurement_type": "temperatur"},
    "temp morgen": {"function": "settpunkt (morgen)", "measurement_type": "temperatur"},
    "flow": {"measurement_type": "volum"},
    "vav": {"measurement_type": "volum"},
    "setp": {"function": "settpunkt"},
    "slave": {"function": "grenseverdi (slave-parameter)"},
}
# The quantity that a sensor's letters measure.
LETTER_QUANTITY = {
    "RT": "temperatur",
    "RI": "temperatur",
    "RD": "trykk",
    "RP": "trykk",
    "RQ": "trykk",
    "RY": "co2",
    "RH": "annet",
    "RF": "volum",
    "RN": "annet",
    "RE": "effekt",
}
# Sides, carriers of systems, and what command and input objects are.
SIDES = {"4": "tur/tilluft (supply)", "5": "retur/fraluft (return)"}
SYSTEM_CARRIER = {"37": "kjoling"}
OBJECT_DEFAULTS = {
    "AO": ("kommando", "utgang (analogt paadrag)"),
    "BO": ("kommando", "utgang (binaer kommando)"),
    "BI": ("status", "status (binaer inngang)"),
}
# Fixed value: what a system number says that the list lacks.
UNKNOWN_CODE = " (code %s not in the TFM list -- left uninterpreted)"
CONFIDENCE_CAP, LOW_CONFIDENCE = 0.90, 0.4
STRUCTURAL = ("primary_system", "carrier", "component", "is_derived", "object_type")


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key] if table else F.lit(None).cast("string")


def version_stamp(*tables: DataFrame) -> DataFrame:
    """One row with ``version``: twelve digits that change with any row of what a decode rests on, whatever the rows' order."""
    rows = None
    for k, t in enumerate(tables):
        line = F.concat_ws("\x1f", F.lit(str(k)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(t.columns)])
        part = t.select(F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long").alias("h"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.agg(F.substring(F.sha2(F.concat_ws(":", F.count("*").cast("string"), F.coalesce(F.sum("h"), F.lit(0)).cast("string")), 256), 1, 12).alias("version"))


def decode_rules(labels: DataFrame, components: dict[str, str], systems: dict[str, str], areas: dict[str, str] | None = None, keywords: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """``labels(raw_label, source_type)`` decoded by rules alone.

    ``components``: letters to meaning; ``systems``: three digits to name; ``areas``: control number to area. They are
    small reference tables and go into the plan as literals, so decoding needs no join. ``keywords``: rules in place of
    ``KEYWORDS``, such as ``sources.files.rules`` reads.

    The rules stand in a few projections, each over what the one before found, and not in one for each rule: plans of
    dozens of projections take more memory and time on the driver than the labels take on the executors.
    """
    rules = KEYWORDS if keywords is None else keywords
    col, lit, known = F.col, F.lit, lambda *cs: F.coalesce(*cs).isNotNull()
    d = lb.with_tokens(labels)

    # What tokens consist of.
    letters_of = F.array(*[lit(k) for k in components]) if components else F.array().cast("array<string>")
    combined = {f"c_{k}": lb.group(col("combined"), lb.COMBINED, n) for n, k in enumerate(("system", "number", "letters", "digits"), 1)}
    point = {f"p_{k}": lb.group(col("point_token"), lb.POINT_CODE, n) for n, k in enumerate(("letters", "side", "tail"), 1)}
    core = F.ltrim(col("point_token"), lit("-"))
    device = F.get(F.filter("segs", lambda s: s.rlike(lb.EQUIPMENT_TOKEN) & F.array_contains(letters_of, F.regexp_extract(s, r"^([A-Z]{1,3})\d{3}", 1))), lit(0))
    d = d.withColumns(combined | point | {"core": core, "device": device, "hay": F.lower(F.array_join("segs", " "))})

    # What they mean. Of the keywords in a label the longest is first.
    words = sorted(rules, key=len, reverse=True)
    first3 = F.substring("system_digits", 1, 3)
    d = d.withColumns(
        {
            "s_name": lookup(systems, first3), "c_name": lookup(systems, col("c_system")),
            "c_meaning": lookup(components, col("c_letters")), "c_quantity": lookup(LETTER_QUANTITY, col("c_letters")),
            "p_meaning": lookup(components, col("p_letters")), "p_quantity": lookup(LETTER_QUANTITY, col("p_letters")),
            "side": F.when(F.length(F.concat("p_side", "p_tail")) == 3, lookup(SIDES, col("p_side"))),
            "io_point": F.when(col("p_letters").isNull(), lb.group(col("core"), lb.IO_POINT, 1)),
            "e_letters": F.regexp_extract("device", r"^([A-Z]{1,3})\d{3}", 1), "e_code": F.regexp_extract("device", r"^[A-Z]{1,3}\d{3}", 0),
            "own": F.coalesce("bygg", "control_number"),
            "words": F.array_compact(F.array(*[F.when(col("hay").contains(w), w) for w in words])) if words else F.array().cast("array<string>"),
        }
    )

    # What the structure of a label says, and what its keywords say.
    said = lambda field: F.get(F.filter(F.transform("words", lambda w: lookup({w: rules[w][field] for w in words if field in rules[w]}, w)), lambda v: v.isNotNull()), lit(0))
    lone, in_own = known("bygg_alone"), known("own")
    meant = lambda code, letters, meaning: F.concat(code, lit(" ("), letters, lit(" = "), meaning, lit(")"))
    named = F.coalesce(meant(F.concat("c_letters", "c_digits"), col("c_letters"), col("c_meaning")), meant(col("core"), col("p_letters"), col("p_meaning")))
    fill = known("p_meaning") & known("p_quantity") & ~(known("c_meaning") & known("c_quantity"))
    part = F.when(known("combined"), F.concat(lit("system "), col("c_system"), lit("."), col("c_number"), F.when(col("c_name").isNull(), F.format_string(UNKNOWN_CODE, "c_system")).otherwise("")))
    whole = F.when(known("s_name"), F.concat(lit("system "), first3, lit("."), F.substring("system_digits", 4, 10)))
    side = F.when(known("p_meaning"), col("side"))
    etg = F.when(lone & (~in_own | (col("own") == col("bygg_alone"))), col("etg"))
    d = d.withColumns(
        {
            "building": F.when(in_own, col("own")).otherwise(col("bygg_alone")),
            "zone": F.coalesce(F.concat(lit("Rom "), col("room")), etg),
            "subsystem": F.when(known(side, whole, part), F.concat_ws("; ", side, whole, part)),
            "named": named, "fill": fill,
            "object_type": F.coalesce("io_point", "io_type"),
            "system_code": F.when(known("s_name"), F.concat(first3, lit("0"))).when(known("c_name"), F.concat("c_system", lit("0"))),
            "system_name": F.coalesce("s_name", "c_name"),
            "quantity": F.coalesce(F.when(known("c_meaning"), col("c_quantity")), F.when(known("p_meaning"), col("p_quantity"))),
            "hint": said("system_hint"), "unit": said("unit"),
            **{f"w_{f}": said(f) for f in ("function", "measurement_type", "carrier", "component")},
        }
    )
    by_kind = lambda n: lookup({k: v[n] for k, v in OBJECT_DEFAULTS.items()}, col("object_type"))
    of_device = known("device") & col("named").isNull()
    set_point = F.coalesce(col("point_suffix").isin("_SP", "_WSP"), lit(False))
    hinted = col("system_code").isNull() & known("hint_name")
    d = d.withColumn("hint_name", lookup(systems, col("hint"))).withColumns(
        {
            "function": F.coalesce(F.when(set_point, "settpunkt"), F.when(col("fill"), col("p_quantity")), by_kind(1), "w_function"),
            "measurement_type": F.coalesce("quantity", by_kind(0), "w_measurement_type"),
            "component": F.coalesce("named", F.when(of_device, meant(col("e_code"), col("e_letters"), lookup(components, col("e_letters")))), "w_component"),
            "hinted": hinted,
            "system_code": F.when(hinted, F.concat("hint", lit("0"))).otherwise(col("system_code")),
            "system_name": F.when(hinted, col("hint_name")).otherwise(col("system_name")),
        }
    )

    # Why: of each rule that holds, what it adds to the score and a note.
    area = F.when(col("bygg").isNull(), lookup(areas or {}, col("control_number")))
    worded = (F.size("words") > 0) & known("function", "measurement_type", "w_carrier")
    reasons = [
        (in_own, 0.05, F.concat(lit("building "), col("own"), F.coalesce(F.concat(lit(", area "), area), lit("")))),
        (lone & in_own & known("etg") & (col("own") == col("bygg_alone")), 0.0, F.concat(lit("floor "), col("etg"))),
        (lone & ~in_own, 0.05, F.concat(lit("building "), col("bygg_alone"))),
        (known("s_name"), 0.20, F.concat(lit("system token "), col("system_digits"))),
        (known("room"), 0.05, F.concat(lit("room "), col("room"))),
        (known("c_name") & col("s_name").isNull(), 0.20, F.concat(lit("combined token "), col("combined"))),
        (known("combined"), 0.0, lit("combined token's subsystem")),
        (known("c_meaning"), 0.20, F.concat(lit("component "), col("c_letters"))),
        (known("p_meaning"), 0.20, F.concat(lit("point code "), col("core"))),
        (col("fill"), 0.10, F.concat(lit("quantity of "), col("p_letters"))),
        (known("p_meaning") & known("side"), 0.0, lit("side digit")),
        (known("io_point"), 0.10, F.concat(lit("I/O point "), col("core"))),
        (of_device, 0.20, F.concat(lit("equipment "), col("device"), F.when(col("device").endswith("_TEST"), " (test set-up)").otherwise(""))),
        (col("io_point").isNull() & known("io_type"), 0.10, F.concat(lit("object type "), col("io_type"))),
        *[(F.coalesce(col("object_type") == k, lit(False)), 0.0, lit(f"{k} object")) for k in OBJECT_DEFAULTS],
        (set_point, 0.10, lit("set-point suffix")),
        (worded, 0.10, F.concat(lit("keywords "), F.array_join("words", ", "))),
        (col("hinted"), 0.10, F.concat(lit("system hint "), col("hint"))),
    ]
    notes = F.array_compact(F.array(*[F.when(on, note) for on, _, note in reasons]))
    score = sum((F.when(on, add).otherwise(0.0) for on, add, _ in reasons if add), lit(0.30))

    d = d.withColumns({"carrier": F.coalesce("w_carrier", lookup(SYSTEM_CARRIER, F.substring("system_code", 1, 2))), "is_derived": F.when(known("component", "measurement_type", "object_type"), False), "tier": tier(), "confidence": F.round(F.least(F.round(score, 6), lit(CONFIDENCE_CAP)), 2), "reasoning": F.coalesce(F.nullif(F.array_join(notes, "; "), lit("")), lit("no deterministic rule matched")), "decode_method": lit("rules")})
    system = F.when(known("system_code"), F.struct(col("system_code").alias("code"), col("system_name").alias("description")))
    place = F.when(known("building", "zone"), F.struct("building", "zone"))
    return d.select("raw_label", "source_type", "carrier", "function", "measurement_type", "unit", "object_type", system.alias("primary_system"), "subsystem", "component", place.alias("location"), "is_derived", "confidence", "reasoning", "decode_method", "tier")


def tier() -> Column:
    known = sum((F.col(c).isNotNull().cast("int") for c in ("system_code", "component", "function", "measurement_type")), F.lit(0))
    return F.when(known >= 3, "FULL").when(known >= 1, "PARTIAL").otherwise("NONE")


def last_rows(rows: DataFrame, arrival: str = "arrival") -> DataFrame:
    """The last row of each label, by ``arrival`` where there is such a column, else as read."""
    if arrival not in rows.columns:
        rows = rows.withColumn(arrival, F.monotonically_increasing_id())
    names = [c for c in rows.columns if c not in ("raw_label", arrival)]
    return rows.groupBy("raw_label").agg(F.max_by(F.struct(*names), arrival).alias("_r")).select("raw_label", "_r.*")


def retrieve(decoded: DataFrame, store: DataFrame) -> DataFrame:
    """Rules completed from ``store``: an exact label's record replaces them; else a sibling of the family lends its structure.

    The sibling is of equal signature, with the same point name if there is one, and the smallest label then. Only
    structural fields are lent, into nulls; lending costs confidence. Of a label that the store repeats, the last
    record counts (``last_rows``).
    """
    store = last_rows(store)
    fields = [c for c in decoded.columns if c not in ("raw_label", "source_type", "tier")]
    kept = store.select("raw_label", *[F.col(c).alias(f"_s_{c}") for c in fields if c in store.columns])
    exact = decoded.join(kept, "raw_label", "left").withColumn("_hit", F.col("_s_confidence").isNotNull())
    exact = exact.withColumns({c: F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)) for c in fields if c in store.columns and c != "decode_method"})
    exact = exact.withColumn("decode_method", F.when(F.col("_hit"), "retrieval").otherwise(F.col("decode_method"))).drop(*[f"_s_{c}" for c in fields])

    named = store.select(lb.signature(F.col("raw_label")).alias("_sig"), lb.point_name(F.col("raw_label")).alias("_name"), F.col("raw_label").alias("_from"), F.col("confidence").alias("_conf"), *[F.col(c).alias(f"_t_{c}") for c in STRUCTURAL])
    by_name = named.groupBy("_sig", "_name").agg(F.min_by(F.struct("_from", "_conf", *[f"_t_{c}" for c in STRUCTURAL]), "_from").alias("_same"))
    by_sig = named.groupBy("_sig").agg(F.min_by(F.struct("_from", "_conf", *[f"_t_{c}" for c in STRUCTURAL]), "_from").alias("_any"))
    keyed = exact.withColumns({"_sig": lb.signature(F.col("raw_label")), "_name": lb.point_name(F.col("raw_label"))})
    found = keyed.join(by_sig, "_sig", "left").join(by_name, ["_sig", "_name"], "left").withColumn("_t", F.when(~F.col("_hit"), F.coalesce("_same", "_any")))
    lent = {c: F.col(c).isNull() & F.col(f"_t._t_{c}").isNotNull() for c in STRUCTURAL}
    any_lent = F.coalesce(F.greatest(*[F.coalesce(v, F.lit(False)) for v in lent.values()]), F.lit(False))
    found = found.withColumn("_lent", any_lent)
    found = found.withColumns({c: F.coalesce(F.col(c), F.col(f"_t._t_{c}")) for c in STRUCTURAL})
    conf = F.round(F.least(F.lit(CONFIDENCE_CAP), F.greatest("confidence", F.coalesce("_t._conf", F.lit(0.5)) - 0.1)), 2)
    found = found.withColumns({"confidence": F.when(F.col("_lent"), conf).otherwise(F.col("confidence")), "decode_method": F.when(F.col("_lent"), "rules+retrieval").otherwise(F.col("decode_method")), "sibling": F.col("_t._from")})
    found = found.withColumns({"system_code": F.col("primary_system.code")}).withColumn("tier", tier())
    return found.select(*decoded.columns, "sibling")


def residue(decoded: DataFrame) -> DataFrame:
    """Rows too thin to keep, in the shape of the input."""
    return decoded.where((F.col("tier") == "NONE") | (F.col("confidence") < LOW_CONFIDENCE)).select("raw_label", "source_type")


def split_batch(decoded: DataFrame) -> DataFrame:
    """Decoded rows with ``reason``: why a row goes on to a second source (``thin`` or ``invalid``), null where it is an output.

    A row that breaks the record's contract is no output, however much of it is decoded.
    """
    judged = record_violations(decoded)
    thin = (F.col("tier") == "NONE") | (F.coalesce("confidence", F.lit(0.0)) < LOW_CONFIDENCE)
    return judged.withColumn("reason", F.when(thin, "thin").when(F.size("violations") > 0, "invalid")).drop("record")


def batch_counts(split: DataFrame) -> DataFrame:
    """Rows of a split batch by method, tier and reason."""
    return split.groupBy("decode_method", "tier", "reason").agg(F.count("*").alias("n"))


def coverage(decoded: DataFrame) -> DataFrame:
    """Rows by family, method and tier."""
    fam = decoded.withColumn("family", lb.signature(F.col("raw_label")))
    return fam.groupBy("family").agg(F.count("*").alias("rows"), *[F.count_if(F.col("tier") == t).alias(t.lower()) for t in ("FULL", "PARTIAL", "NONE")], F.count_if(F.col("decode_method") != "rules").alias("from_store"))


def readiness_gaps() -> Column:
    return F.array_compact(
        F.array(
            F.when(F.col("primary_system").isNull(), "primary_system"),
            F.when(F.col("measurement_type").isNull() & F.col("function").isNull(), "point_semantics"),
            F.when(F.coalesce(F.col("location.building"), F.lit("")) == "", "building"),
            F.when(F.coalesce("confidence", F.lit(0.0)) <= LOW_CONFIDENCE, "low_confidence"),
        )
    )


def enrichment(decoded: DataFrame, dedupe: bool = True) -> DataFrame:
    """Rows with a gap that more evidence could close (never the building's); one per family, the smallest label."""
    gaps = decoded.withColumn("gaps", readiness_gaps()).withColumn("selected_for", F.array_except("gaps", F.array(F.lit("building")))).where(F.size("selected_for") > 0)
    gaps = gaps.withColumn("family", lb.signature(F.col("raw_label")))
    sizes = gaps.groupBy("family").agg(F.count("*").alias("family_size"), F.min("raw_label").alias("_first"))
    out = gaps.join(sizes, "family")
    if dedupe:
        out = out.where(F.col("raw_label") == F.col("_first")).dropDuplicates(["raw_label"])
    return out.select("raw_label", "source_type", "gaps", "selected_for", "family", "family_size", "confidence")


MERGED = ("carrier", "function", "measurement_type", "unit", "object_type", "primary_system", "subsystem", "component", "is_derived")


def _sound(second: DataFrame) -> DataFrame:
    return second.where(~F.coalesce("schema_invalid", F.lit(False))).drop("schema_invalid") if "schema_invalid" in second.columns else second


def merge_second(decoded: DataFrame, second: DataFrame) -> DataFrame:
    """Fills nulls from a second source's rows, keeps the first's values, and lists conflicts.

    Rows marked ``schema_invalid`` are skipped, and of a repeated label the last sound row counts. A null ``location`` takes
    the second's whole, else its null members are filled. A merge whose carrier, quantity or object type would break the
    contract keeps the first row and notes a conflict of field ``_schema``.
    """
    fields = [c for c in MERGED if c in second.columns]
    members = ("building", "zone") if "location" in second.columns else ()
    place = [F.col("location").alias("_2location")] if members else []
    rows = last_rows(_sound(second)).select("raw_label", F.col("confidence").alias("_c2"), *[F.col(c).alias(f"_2{c}") for c in fields], *place)
    both = decoded.join(rows, "raw_label", "left")
    text = lambda c: (F.col(c)["code"] if c.endswith("primary_system") else F.col(c)).cast("string")
    entry = lambda field, a, b: F.struct(F.lit(field).alias("field"), a.alias("first"), b.alias("second"))
    take = [F.when(F.col(c).isNull() & F.col(f"_2{c}").isNotNull(), c) for c in fields]
    clash = [F.when(F.col(c) != F.col(f"_2{c}"), entry(c, text(c), text(f"_2{c}"))) for c in fields]
    if members:
        none = F.col("location").isNull()
        take.append(F.when(none & F.col("_2location").isNotNull(), "location"))
        take += [F.when(~none & F.col(f"location.{m}").isNull() & F.col(f"_2location.{m}").isNotNull(), f"location.{m}") for m in members]
        clash += [F.when(F.col(f"location.{m}") != F.col(f"_2location.{m}"), entry(f"location.{m}", F.col(f"location.{m}"), F.col(f"_2location.{m}"))) for m in members]
    both = both.withColumns({"adopted": F.array_compact(F.array(*take)), "conflicts": F.array_compact(F.array(*clash))})
    new = {c: F.coalesce(c, f"_2{c}") for c in fields}
    if members:
        new["location"] = F.when(F.col("location").isNull(), F.col("_2location")).otherwise(F.struct(*[F.coalesce(f"location.{m}", f"_2location.{m}").alias(m) for m in members]))
    broken = F.coalesce(F.greatest(F.lit(False), *[(~new[c].isin(*ENUMS[c])) & F.col(c).isNull() for c in fields if c in ENUMS]), F.lit(False))
    both = both.withColumn("_broken", broken)
    conf = F.round(F.least(F.lit(CONFIDENCE_CAP), F.greatest("confidence", F.col("_c2") - 0.1)), 2)
    took = (F.size("adopted") > 0) & ~F.col("_broken")
    out = both.withColumns({c: F.when(F.col("_broken"), F.col(c)).otherwise(v) for c, v in new.items()})
    out = out.withColumns({"conflicts": F.when(F.col("_broken"), F.concat("conflicts", F.array(entry("_schema", F.lit("kept"), F.lit("merge invalid"))))).otherwise(F.col("conflicts")), "confidence": F.when(took, conf).otherwise(F.col("confidence")), "decode_method": F.when(took, F.concat("decode_method", F.lit("+llm"))).otherwise(F.col("decode_method"))})
    return out.withColumn("adopted", F.when(F.col("_broken"), F.array().cast("array<string>")).otherwise(F.col("adopted"))).drop("_c2", "_broken", *[f"_2{c}" for c in fields], *(["_2location"] if members else []))


def merge_stats(decoded: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of the second source, and how many were skipped as invalid or as of no decoded label."""
    bad = F.coalesce("schema_invalid", F.lit(False)) if "schema_invalid" in second.columns else F.lit(False)
    rows = second.select("raw_label", bad.alias("_bad")).join(decoded.select("raw_label", F.lit(True).alias("_known")).distinct(), "raw_label", "left")
    return rows.agg(F.count("*").alias("second_rows"), F.count_if("_bad").alias("schema_invalid"), F.count_if(~F.col("_bad") & F.col("_known").isNull()).alias("unknown_label"))


def merge_report(merged: DataFrame) -> DataFrame:
    """Rows of a merge by what it did: enriched ones, those with a conflict, those whose merge the contract refused, and fields adopted."""
    held = lambda f: F.exists("conflicts", lambda c: c["field"] == f)
    return merged.agg(
        F.count("*").alias("n"),
        F.count_if(F.size("adopted") > 0).alias("rows_enriched"),
        F.count_if(F.size("conflicts") > 0).alias("conflict_rows"),
        F.count_if(held("_schema")).alias("merge_invalid"),
        F.sum(F.size("adopted")).cast("long").alias("fields_adopted"),
        F.sum(F.size(F.filter("conflicts", lambda c: c["field"] != "_schema"))).cast("long").alias("field_conflicts"),
    )


#: Fixed value: what looks like a component code, wherever it stands.
CODE_LIKE = r"(?<![A-Za-z])([A-Za-z]{2}\d{2,3})(?!\d)"
#: Fields whose loss a probe counts, as columns of a decoded row.
PROBED = {"system_code": "primary_system", "subsystem": "subsystem", "component": "component", "function": "function", "measurement_type": "measurement_type", "object_type": "object_type", "location": "location", "carrier": "carrier"}
# What the record's contract allows.
ENUMS = {
    "carrier": ("el", "fjernvarme", "kjoling", "gass", "vann", "annet"),
    "measurement_type": ("energi", "effekt", "temperatur", "volum", "trykk", "kostnad", "co2", "status", "kommando", "annet"),
    "object_type": ("AV", "BV", "MV", "AI", "AO", "BI", "BO", "MI", "MO"),
}


def mutations(labels: DataFrame, *more: str) -> DataFrame:
    """Rewritings that another vendor or site might use, of each label to which they apply: ``(raw_label, source_type, mutation, mutated)``.

    ``more``: columns of ``labels`` that come with each."""
    x = F.col("raw_label")
    slash = F.instr(x, "/")
    head = F.when(slash > 0, F.substr(x, F.lit(1), slash - 1)).otherwise(x)
    tail = F.when(slash > 0, F.substr(x, slash + 1, F.length(x)))
    whole = F.coalesce(tail, x)
    gaps, codes = F.split(x, CODE_LIKE, -1), F.regexp_extract_all(x, F.lit(CODE_LIKE), F.lit(1))
    lowered = F.concat(F.array_join(F.zip_with(F.slice(gaps, 1, F.size(codes)), codes, lambda g, c: F.concat(g, F.lower(c))), ""), F.element_at(gaps, -1))
    kinds = {
        "swap": F.when(whole.contains("-") | x.contains("_"), F.concat(head, F.lit("/"), F.translate(whole, "-_", "_-"))),
        "lowercase": F.when(lowered != x, lowered),
        "spaces": F.when(tail.rlike("[-_]"), F.concat(head, F.lit("/"), F.translate(tail, "-_", "  "))),
        "displaced": F.when(x.contains(".#"), F.regexp_replace(x, r"^(?s)(.*)\.#", r"$1_X.#")),
    }
    each = F.array(*[F.struct(F.lit(k).alias("mutation"), v.alias("mutated")) for k, v in kinds.items()])
    return labels.withColumn("m", F.explode(each)).select("raw_label", "source_type", *more, "m.*").where("mutated is not null")


def mutation_losses(labels: DataFrame, decode) -> DataFrame:
    """Of labels that ``decode`` gives a component or object type: by rewriting, how many were tried, broke, and lost each field.

    What was decoded is staged as flags, so that the driver plans one decoding at a time and never one within the other.
    """
    flags = lambda name: F.struct(*[F.col(c).isNotNull().alias(f) for f, c in PROBED.items()]).alias(name)
    base = staged(decode(labels).select("raw_label", "source_type", flags("old"))).where("old.component or old.object_type")
    tried = mutations(base, "old")
    again = staged(decode(tried.select(F.col("mutated").alias("raw_label"), "source_type").distinct()).select(F.col("raw_label").alias("mutated"), "source_type", flags("new")))
    both = tried.join(again, ["mutated", "source_type"])
    lost = {f: F.col(f"old.{f}") & ~F.col(f"new.{f}") for f in PROBED}
    return both.groupBy("mutation").agg(F.count("*").alias("tried"), F.count_if(F.greatest(*lost.values())).alias("broke"), *[F.count_if(v).alias(f"lost_{f}") for f, v in lost.items()])


def null_rates(decoded: DataFrame) -> DataFrame:
    """Of each probed field: rows, nulls and their share."""
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(c).isNull().alias("gone")) for f, c in PROBED.items()])
    rows = decoded.select(F.explode(cells).alias("c")).groupBy("c.field").agg(F.count("*").alias("n"), F.count_if("c.gone").alias("nulls"))
    return rows.withColumn("null_rate", F.col("nulls") / F.col("n"))


def recognised(segment: Column) -> Column:
    """Whether a pattern of the label grammar, a path word or a keyword claims a segment."""
    core, low = F.regexp_replace(segment, lb.SETPOINT_SUFFIX, ""), F.lower(segment)
    whole = [segment.rlike(p) for p in (lb.SYSTEM_TOKEN, lb.EQUIPMENT_TOKEN, lb.MODBUS_TOKEN, lb.COMBINED, lb.BYGG_ETG, lb.ROOM)]
    inner = [core.rlike(lb.POINT_CODE), F.ltrim(core, F.lit("-")).rlike(lb.IO_POINT), core.rlike(lb.EMBEDDED_TAIL)]
    return F.greatest(*whole, *inner, low.isin(*lb.PATH_OBJECTS), *[F.instr(low, w) > 0 for w in KEYWORDS])


def unrecognised(labels: DataFrame) -> DataFrame:
    """Families of path segments that nothing claims, with their number and the smallest example."""
    rows = labels.select(F.explode(lb.segments(F.col("raw_label"))).alias("s")).where(~recognised(F.col("s")))
    return rows.groupBy(lb.signature(F.col("s")).alias("family")).agg(F.count("*").alias("n"), F.min("s").alias("example"))


def missed_codes(decoded: DataFrame) -> DataFrame:
    """Labels without a component although something in them looks like a code: ``(raw_label, codes)``."""
    found = F.sort_array(F.array_distinct(F.regexp_extract_all(lb.after(F.col("raw_label"), ":"), F.lit(CODE_LIKE), F.lit(1))))
    return decoded.where("component is null").select("raw_label", found.alias("codes")).where(F.size("codes") > 0)
