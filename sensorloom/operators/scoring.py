"""Scoring decoded records against gold records: alignment, field verdicts, accuracy, calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as lb
from ..functions.numbers import wilson
from .decode import ENUMS

# Scored fields and how they compare; core fields decide a row's core exactness.
FIELDS = {
    "carrier": "enum",
    "function": "text",
    "measurement_type": "enum",
    "unit": "enum",
    "object_type": "enum",
    "system_code": "code",
    "subsystem": "text",
    "component": "text",
    "building": "text",
    "zone": "text",
    "is_derived": "bool",
}
CORE = ("carrier", "measurement_type", "system_code", "component", "function")


def last_wins(df: DataFrame, order: str) -> DataFrame:
    """The last row of each label."""
    names = [c for c in df.columns if c not in ("raw_label", order)]
    return df.groupBy("raw_label").agg(F.max_by(F.struct(*names), order).alias("_r"), F.count("*").alias("n_rows")).select("raw_label", "_r.*", "n_rows")


def align(gold: DataFrame, outputs: DataFrame) -> DataFrame:
    """Each label as matched, missing or extra, and whether a side repeats it."""
    g = gold.groupBy("raw_label").agg(F.count("*").alias("in_gold"))
    o = outputs.groupBy("raw_label").agg(F.count("*").alias("in_outputs"))
    both = g.join(o, "raw_label", "full_outer")
    kind = F.when(F.col("in_outputs").isNull(), "missing").when(F.col("in_gold").isNull(), "extra").otherwise("matched")
    return both.select("raw_label", kind.alias("alignment"), (F.coalesce("in_gold", F.lit(0)) > 1).alias("gold_repeats"), (F.coalesce("in_outputs", F.lit(0)) > 1).alias("outputs_repeat"))


def near_misses(gold: DataFrame, outputs: DataFrame) -> DataFrame:
    """Extra labels that equal a gold label but for case and white space."""
    extra = outputs.select("raw_label").distinct().join(gold, "raw_label", "left_anti").withColumn("_k", lb.normal_text(F.col("raw_label")))
    g = gold.select(F.col("raw_label").alias("gold_label")).distinct().withColumn("_k", lb.normal_text(F.col("gold_label")))
    return extra.join(g, "_k").select("raw_label", "gold_label")


def _equal(kind: str, g: Column, o: Column) -> Column:
    if kind == "enum":
        return F.trim(g) == F.trim(o)
    if kind == "text":
        return lb.normal_text(g) == lb.normal_text(o)
    if kind == "code":
        return F.coalesce(lb.code_prefix(g) == lb.code_prefix(o), F.trim(g) == F.trim(o))
    return g == o


def field_verdicts(gold: DataFrame, outputs: DataFrame) -> DataFrame:
    """``(raw_label, field, verdict, gold_set)`` of every scored field of every matched label."""
    g = gold.select("raw_label", *[F.col(f).alias(f"g_{f}") for f in FIELDS])
    both = g.join(outputs.select("raw_label", *FIELDS), "raw_label")

    def verdict(f: str, kind: str) -> Column:
        gv, ov = F.col(f"g_{f}"), F.col(f)
        return F.when(gv.isNull() & ov.isNull(), "CORRECT").when(ov.isNull(), "UNDER_FILL").when(gv.isNull(), "OVER_FILL").when(_equal(kind, gv, ov), "CORRECT").otherwise("WRONG_VALUE")

    cells = F.array(*[F.struct(F.lit(f).alias("field"), verdict(f, k).alias("verdict"), F.col(f"g_{f}").isNotNull().alias("gold_set")) for f, k in FIELDS.items()])
    return both.select("raw_label", F.explode(cells).alias("c")).select("raw_label", "c.*")


def field_accuracy(verdicts: DataFrame) -> DataFrame:
    ok = (F.col("verdict") == "CORRECT").cast("int")
    return verdicts.groupBy("field").agg(F.avg(ok).alias("accuracy"), F.avg(F.when(F.col("gold_set"), ok)).alias("nontrivial"), *[F.count_if(F.col("verdict") == v).alias(v.lower()) for v in ("UNDER_FILL", "OVER_FILL", "WRONG_VALUE")], F.count("*").alias("n"))


def weakest(accuracy: DataFrame, k: int = 3) -> DataFrame:
    return accuracy.where("nontrivial < 1").orderBy("nontrivial", "field").limit(k)


def row_exact(verdicts: DataFrame) -> DataFrame:
    ok = F.col("verdict") == "CORRECT"
    return verdicts.groupBy("raw_label").agg(F.bool_and(ok).alias("exact"), F.bool_and(ok | ~F.col("field").isin(*CORE)).alias("core_exact"))


def exact_rates(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("n"), F.avg(F.col("exact").cast("int")).alias("exact_rate"), F.avg(F.col("core_exact").cast("int")).alias("core_rate"))


def calibration(rows: DataFrame, bins: int = 5) -> DataFrame:
    """``rows(confidence, exact)`` by confidence bin, the last one closed, with a Wilson interval."""
    b = F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1)).cast("int")
    y = F.col("exact").cast("int")
    out = rows.where("confidence is not null").groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg(y).alias("accuracy"), F.avg("confidence").alias("mean_confidence"), F.sum(y).alias("hits"))
    low, high = wilson(F.col("hits").cast("double"), F.col("n").cast("double"))
    return out.withColumns({"low": low, "high": high}).drop("hits")


def calibration_scores(rows: DataFrame, bins: int = 5) -> DataFrame:
    """Brier score and expected calibration error."""
    b = F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1)).cast("int")
    y = F.col("exact").cast("double")
    per = rows.where("confidence is not null").groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.sum(F.pow(F.col("confidence") - y, F.lit(2.0))).alias("s"), F.abs(F.avg(y) - F.avg("confidence")).alias("gap"))
    return per.agg((F.sum("s") / F.sum("n")).alias("brier"), (F.sum(F.col("gap") * F.col("n")) / F.sum("n")).alias("ece"), F.sum("n").alias("n"))


def code_exact(gold: DataFrame, outputs: DataFrame, field: str = "system_code") -> DataFrame:
    """Of rows where both sides hold a code: how many, and the share that is equal beyond the compared prefix."""
    both = gold.select("raw_label", F.trim(field).alias("g")).join(outputs.select("raw_label", F.trim(field).alias("o")), "raw_label").where("g is not null and o is not null")
    return both.agg(F.count("*").alias("n"), F.avg((F.col("g") == F.col("o")).cast("int")).alias("code_exact"))


def validity_rate(contract_rows: DataFrame) -> DataFrame:
    """Of ``contract`` rows: outputs, sound labels, and their share; of a repeated label the last row counts, over all outputs."""
    rows = contract_rows.withColumn("_at", F.monotonically_increasing_id())
    last = rows.groupBy("raw_label").agg(F.max_by(F.size("violations") == 0, "_at").alias("ok"), F.count("*").alias("_n"))
    return last.agg(F.sum("_n").alias("n_outputs"), F.count_if("ok").alias("valid"), (F.count_if("ok") / F.sum("_n")).alias("validity_rate"))


def error_rows(gold: DataFrame, outputs: DataFrame, contract_rows: DataFrame) -> DataFrame:
    """``(raw_label, field, kind, predicted, gold, confidence)``: a row per missed field, and one per record that breaks the contract."""
    side = lambda df, name: df.select("raw_label", *(["confidence"] if name == "predicted" else []), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias(name)) for f in FIELDS])).alias("c")).select("raw_label", *(["confidence"] if name == "predicted" else []), "c.*")
    missed = field_verdicts(gold, outputs).where("verdict <> 'CORRECT'").select("raw_label", "field", F.col("verdict").alias("kind"))
    rows = missed.join(side(outputs, "predicted"), ["raw_label", "field"]).join(side(gold, "gold"), ["raw_label", "field"])
    broken = contract_rows.where(F.size("violations") > 0)
    text = F.array_join(F.transform("violations", lambda v: F.concat_ws(": ", v["location"], v["message"])), "; ")
    none = F.lit(None).cast("string")
    broken = broken.select("raw_label", F.lit("(schema)").alias("field"), F.lit("SCHEMA_INVALID").alias("kind"), text.alias("predicted"), none.alias("gold"), F.lit(None).cast("double").alias("confidence"))
    return rows.select(*broken.columns).unionByName(broken)


def confidence_histogram(decoded: DataFrame, bins: int = 5) -> DataFrame:
    """Rows and mean confidence by equal bins of confidence, the last one closed."""
    b = F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1)).cast("int")
    return decoded.where("confidence is not null").groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence"))


def fill_rates(decoded: DataFrame) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).isNotNull().cast("int").alias("set")) for f in FIELDS])
    return decoded.select(F.explode(cells).alias("c")).groupBy("c.field").agg(F.avg("c.set").alias("fill_rate"), F.count("*").alias("n"))


def contract(decoded: DataFrame) -> DataFrame:
    """Violations of the record's contract as ``(location, message)``; a row is valid where there are none."""
    bad = lambda when, where, what: F.when(when, F.struct(F.lit(where).alias("location"), F.lit(what).alias("message")))
    enum = lambda c, *v: F.col(c).isNotNull() & ~F.col(c).isin(*v)
    return decoded.withColumn(
        "violations",
        F.array_compact(
            F.array(
                bad(F.col("raw_label").isNull(), "raw_label", "required"),
                bad(F.col("source_type").isNull() | enum("source_type", "kiona", "bacnet", "other"), "source_type", "not in enum"),
                bad(enum("carrier", *ENUMS["carrier"]), "carrier", "not in enum"),
                bad(enum("measurement_type", *ENUMS["measurement_type"]), "measurement_type", "not in enum"),
                bad(enum("object_type", *ENUMS["object_type"]), "object_type", "not in enum"),
                bad(F.col("confidence").isNull() | (F.col("confidence") < 0) | (F.col("confidence") > 1), "confidence", "out of range"),
            )
        ),
    )
