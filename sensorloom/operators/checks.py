"""Testing decoded labels against their series: checks per label, relationships between labels, promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import pearson
from .groups import SUPPORT as CO_BEHAVIOUR_R
from .groups import pair_correlations
from .series import aligned_pairs

BINARY, ANALOG = ("BI", "BO", "BV"), ("AI", "AO", "AV")
# Plausible bounds of a quantity.
RANGES = {"temperatur": (-40.0, 130.0), "co2": (0.0, 10000.0)}
DIRECTIONAL_R, SUPPLY_PASS, SUPPLY_FAIL = 0.2, 0.9, 0.5


def _says(function: Column, *words: str) -> Column:
    text = F.coalesce(F.lower(function), F.lit(""))
    return F.greatest(F.lit(False), *[F.instr(text, w) > 0 for w in words])


def checks() -> dict[str, Column]:
    """Verdict of each check on a row of decoded fields and series statistics; null where it does not apply."""
    c = F.col
    n, distinct, kind, quantity = c("n_num"), c("distinct"), c("object_type"), c("measurement_type")
    none = n == 0
    setpoint = _says(c("function"), "settpunkt", "setpoint", "borverdi")
    loose = setpoint | _says(c("function"), "grenseverdi")
    status = F.coalesce(quantity == "status", F.lit(False))
    binary = F.coalesce(kind.isin(*BINARY), F.lit(False)) | status
    analog = F.coalesce(kind.isin(*ANALOG), F.lit(False)) | F.coalesce(quantity.isin("temperatur", "co2", "trykk"), F.lit(False))
    command = F.coalesce((kind == "AO") & (quantity == "kommando"), F.lit(False))
    lo = F.when(command, 0.0).when(quantity == "temperatur", RANGES["temperatur"][0]).when(quantity == "co2", RANGES["co2"][0])
    hi = F.when(command, 100.0).when(quantity == "temperatur", RANGES["temperatur"][1]).when(quantity == "co2", RANGES["co2"][1])
    ranged = F.coalesce(quantity.isin("temperatur", "co2", "trykk"), F.lit(False)) | command
    kinds, known = c("file_kinds"), kind.isNotNull() & (F.size("file_kinds") > 0)
    only = lambda k: (F.size(kinds) == 1) & F.array_contains(kinds, k)
    return {
        "binary-expected": F.when(binary, F.when(none, "INCONCLUSIVE").when(distinct <= 2, "PASS").otherwise("CONFLICT")),
        "av-trap": F.when(analog, F.when(status, F.when(~none & (distinct <= 2), "PASS")).when(none, "INCONCLUSIVE").when(F.coalesce(distinct == 2, F.lit(False)), F.when(loose, "PASS").otherwise("CONFLICT")).otherwise("PASS")),
        "range": F.when(ranged, F.when(none | (~command & (quantity == "trykk")), "INCONCLUSIVE").when((c("min") >= lo) & (c("max") <= hi), "PASS").otherwise("CONFLICT")),
        "dead-point": F.when(none, "INCONCLUSIVE").when(F.coalesce(distinct == 1, F.lit(False)), F.when(setpoint | (_says(c("function"), "alarm") & (c("min") == 0)), "PASS").otherwise("INCONCLUSIVE")).otherwise("PASS"),
        "energy-monotonic": F.when(quantity == "energi", F.when(c("monotonic").isNull(), "INCONCLUSIVE").when(c("monotonic"), "PASS").otherwise("CONFLICT")),
        "file-kind": F.when(known, F.when(only("AV") & kind.isin(*BINARY), "CONFLICT").when(only("BV") & kind.isin(*ANALOG), "CONFLICT").when(F.size(kinds) > 1, "INCONCLUSIVE").when(kind.isin(*BINARY, *ANALOG), "PASS")),
    }


def cross_check(decoded: DataFrame, stats: DataFrame) -> DataFrame:
    """Decoded labels with ``checks(name, verdict, evidence)`` and ``data_checks``; labels without statistics have none."""
    both = decoded.join(stats, "raw_label", "left")
    seen = F.format_string("n=%d, range [%s, %s], distinct %s", F.coalesce("n_num", F.lit(0)), F.coalesce(F.col("min").cast("string"), F.lit("-")), F.coalesce(F.col("max").cast("string"), F.lit("-")), F.coalesce(F.col("distinct").cast("string"), F.lit("> cap")))
    found = F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(k).alias("name"), v.alias("verdict"), seen.alias("evidence"))) for k, v in checks().items()]))
    both = both.withColumn("checks", F.when(F.col("n_rows").isNotNull(), found))
    return both.withColumn("data_checks", F.when(F.col("checks").isNotNull(), F.struct(F.lit(None).cast("double").alias("temp_correlation"), F.col("distinct").cast("int").alias("distinct_values"), F.col("monotonic").alias("monotonic"), F.exists("checks", lambda x: x["verdict"] == "CONFLICT").alias("conflict"))))


def missing_statistics(decoded: DataFrame, stats: DataFrame) -> DataFrame:
    """Decoded labels without a row of statistics."""
    return decoded.select("raw_label").join(stats.select("raw_label"), "raw_label", "left_anti")


def augmented(decoded: DataFrame, checked: DataFrame) -> DataFrame:
    """``decoded`` with the ``data_checks`` found for its labels; a row marked ``schema_invalid`` keeps what it has."""
    found = checked.where("data_checks is not null").select("raw_label", F.col("data_checks").alias("_found"))
    rows = decoded if "data_checks" in decoded.columns else decoded.withColumn("data_checks", F.lit(None).cast(found.schema["_found"].dataType))
    broken = F.coalesce("schema_invalid", F.lit(False)) if "schema_invalid" in decoded.columns else F.lit(False)
    rows = rows.join(found, "raw_label", "left").withColumn("data_checks", F.when(broken, F.col("data_checks")).otherwise(F.coalesce("_found", "data_checks")))
    return rows.drop("_found")


def verdict_counts(checked: DataFrame) -> DataFrame:
    return checked.select(F.explode("checks").alias("c")).groupBy("c.name", "c.verdict").agg(F.count("*").alias("n"))


def review_queue(checked: DataFrame) -> DataFrame:
    """Labels with a conflict or an open question, conflicts first."""
    return checked.withColumn("conflicts", F.size(F.filter("checks", lambda x: x["verdict"] == "CONFLICT"))).withColumn("open", F.size(F.filter("checks", lambda x: x["verdict"] == "INCONCLUSIVE"))).where("conflicts > 0 or open > 0")


def promotable(checked: DataFrame) -> DataFrame:
    """Second-source rows that data support: a check passed and none conflicts."""
    verdict = lambda v: F.exists("checks", lambda x: x["verdict"] == v)
    return checked.where(F.col("decode_method").contains("llm") & verdict("PASS") & ~verdict("CONFLICT"))


def approve(store: DataFrame, candidates: DataFrame, approved: DataFrame) -> DataFrame:
    """Rows to append to ``store``: approved candidates that it lacks."""
    return candidates.join(approved, "raw_label", "left_semi").join(store, "raw_label", "left_anti")


#: Members of a group that one task pairs with the whole group.
TILE = 1000


def group_pairs(members: DataFrame) -> DataFrame:
    """Ordered pairs of labels that share a group, from ``members(raw_label, kind, key)``.

    A large group is paired tile by tile: each label is in one tile, which meets the whole group.
    """
    m = members.select("raw_label", "kind", "key").distinct()
    sizes = m.groupBy("kind", "key").agg(F.count("*").alias("_n")).where("_n > 1").withColumn("_tiles", F.ceil(F.col("_n") / TILE).cast("int")).drop("_n")
    inside = m.join(sizes, ["kind", "key"])
    own = inside.select(F.col("raw_label").alias("source"), "kind", "key", F.pmod(F.xxhash64("raw_label"), F.col("_tiles")).cast("int").alias("_tile"))
    other = inside.select(F.col("raw_label").alias("target"), "kind", "key", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)).alias("_tile"))
    return own.join(other, ["kind", "key", "_tile"]).where("source <> target").select("source", "target", "kind", "key").dropDuplicates(["source", "target", "kind"])


def relationships(pairs: DataFrame) -> DataFrame:
    """An ordered array of relationships per label."""
    return pairs.groupBy(F.col("source").alias("raw_label")).agg(F.sort_array(F.collect_list(F.struct(F.col("kind").alias("type"), F.col("target").alias("target_raw_label")))).alias("relationships"))


def directional(decoded: DataFrame, stats: DataFrame, series: DataFrame, outdoor: DataFrame) -> DataFrame:
    """Heating points should fall and cooling points rise with ``outdoor(ts_text, ref)``."""
    code = F.col("primary_system.code")
    want = F.when(code.startswith("32"), -1).when(code.startswith("37"), 1)
    rows = decoded.withColumn("want", want).where("want is not null").join(stats.select("raw_label", "distinct", "is_binary"), "raw_label", "left")
    r = series.join(outdoor, "ts_text").groupBy("raw_label").agg(F.count("*").alias("n"), pearson("value", "ref").alias("r"))
    rows = rows.join(r, "raw_label", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    signed = F.col("want") * F.col("r")
    verdict = (
        F.when(_says(F.col("function"), "settpunkt", "setpoint", "borverdi"), "SKIPPED")
        .when(F.coalesce(F.col("distinct") <= 1, F.lit(False)) | F.coalesce("is_binary", F.lit(False)) | F.col("r").isNull() | F.coalesce(F.col("measurement_type") == "kommando", F.lit(False)), "SKIPPED")
        .when(signed >= DIRECTIONAL_R, "PASS")
        .when(signed <= -DIRECTIONAL_R, "CONFLICT")
        .otherwise("NO_SIGNAL")
    )
    return rows.select("raw_label", "want", "n", "r", verdict.alias("verdict"))


def supply_return(series: DataFrame, roles: DataFrame) -> DataFrame:
    """``roles(raw_label, key, letters, side)``: of each supply and return of a group, whether supply reads higher."""
    s = roles.where("side = '4'").select("key", "letters", F.col("raw_label").alias("a"))
    r = roles.where("side = '5'").select("key", "letters", F.col("raw_label").alias("b"))
    pairs = s.join(r, ["key", "letters"]).select("a", "b").distinct()
    both = aligned_pairs(series, pairs).groupBy("a", "b").agg(F.count("*").alias("n"), F.avg((F.col("x") > F.col("y")).cast("int")).alias("above"))
    verdict = F.when(F.col("n") < 2, "SKIPPED").when(F.col("above") >= SUPPLY_PASS, "PASS").when(F.col("above") < SUPPLY_FAIL, "CONFLICT").otherwise("NO_SIGNAL")
    return both.withColumn("verdict", verdict)


def co_behaviour(series: DataFrame, members: DataFrame, constants: DataFrame) -> DataFrame:
    """Correlation of each unordered pair of a group; labels that are constant are dropped before pairing. Groups may be of any size."""
    both = pair_correlations(series, members, constants)
    return both.withColumn("verdict", F.when(F.col("r").isNull(), "SKIPPED").when(F.abs("r") >= CO_BEHAVIOUR_R, "SUPPORTED").otherwise("NO_SIGNAL"))
