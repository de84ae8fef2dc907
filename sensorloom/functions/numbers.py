"""Numeric expressions: guarded parsing, correlation, quartiles and intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts read as numbers: optional sign, digits, exponent, or an infinity.
NUMBER = r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|(?i:inf|infinity))$"


def parse_number(text: Column) -> Column:
    """The number a text spells, else null; not-a-number spellings are null too, infinities are numbers."""
    trimmed = F.trim(text)
    sign = F.when(trimmed.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(trimmed.rlike(r"^[+-]?(?i:inf|infinity)$"), sign).when(trimmed.rlike(NUMBER), trimmed.try_cast("double"))


def pearson(x: str, y: str) -> Column:
    """Correlation of two columns as an aggregate; null under two samples or where a side is constant."""
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.when((F.count(F.lit(1)) >= 2) & (F.min(x) < F.max(x)) & (F.min(y) < F.max(y)) & (spread > 0), F.covar_pop(x, y) / spread)


def exclusive_quantile(values: Column, k: int, n: int = 4) -> Column:
    """The k-th of n-1 cut points of a sorted array, with positions k(m+1)/n and interpolation; wants two values or more."""
    m = F.size(values)
    at = F.least(F.greatest(F.floor(F.lit(k) * (m + 1) / n).cast("int"), F.lit(1)), m - 1)
    delta = F.lit(k) * (m + 1) - at * n
    return (F.element_at(values, at) * (n - delta) + F.element_at(values, at + 1) * delta) / n


def middle(values: Column) -> Column:
    """The median of a sorted array."""
    m = F.size(values)
    half = F.floor(m / 2).cast("int")
    return F.when(m == 0, None).when(m % 2 == 1, F.get(values, half)).otherwise((F.get(values, half - 1) + F.get(values, half)) / 2)


def wilson(successes: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the Wilson score interval."""
    p, z2 = successes / n, z * z
    mid = (p + z2 / (2 * n)) / (1 + z2 / n)
    half = F.lit(z) * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n)
    return F.greatest(F.lit(0.0), mid - half), F.least(F.lit(1.0), mid + half)
