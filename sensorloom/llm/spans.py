"""Places of regular-expression matches in a text, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 128


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0).cast("int"), lambda a, x: a + x)


def sums_before(xs: Column) -> Column:
    """For an array of ints, the sum of what stands before each: by blocks, so the work is far below the square of its size."""

    def with_blocks(v: Column) -> Column:
        blocks = F.when(F.size(v) == 0, F.array().cast("array<int>")).otherwise(F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _BLOCK).cast("int")), lambda b: _sum(F.slice(v, b * _BLOCK + 1, _BLOCK))))
        before = lambda bs: F.transform(bs, lambda _, i: _sum(F.slice(bs, 1, i)))
        inside = lambda bs: F.transform(v, lambda _, i: F.get(bs, F.floor(i / _BLOCK).cast("int")) + _sum(F.slice(v, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)))
        return let(blocks, lambda b: let(before(b), inside))

    return let(xs, with_blocks)


def matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """Array of ``(start, end, text, part)`` of the leftmost non-overlapping matches, in code points, end exclusive.

    ``part`` is capture ``group`` of the match. The pattern must not match the empty string. Texts without a match
    are told apart by one scan.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group is not None else found
    gaps = F.split(text, pattern, -1)

    def placed(v: Column) -> Column:
        n = F.size(v["m"])
        gap, size = F.transform(F.slice(v["g"], 1, n), F.length), F.transform(v["m"], F.length)
        starts = F.zip_with(sums_before(F.zip_with(gap, size, lambda a, b: a + b)), gap, lambda a, b: a + b)
        return F.transform(F.arrays_zip(starts.alias("s"), v["m"].alias("m"), v["p"].alias("p")), lambda x: F.struct(x["s"].alias("start"), (x["s"] + F.length(x["m"])).alias("end"), x["m"].alias("text"), x["p"].alias("part")))

    some = let(F.struct(found.alias("m"), parts.alias("p"), gaps.alias("g")), placed)
    none = F.array().cast("array<struct<start:int,end:int,text:string,part:string>>")
    return F.when(text.rlike(pattern), some).otherwise(none)
