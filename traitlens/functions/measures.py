"""Derived measures over parsed bounds (MSR-1..9). Column in, Column out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def span(low: Column, high: Column) -> Column:
    """high - low; NULL unless both are known."""
    return high - low


def midpoint(low: Column, high: Column, places: int | None = None) -> Column:
    """Mean of the bounds, or the known bound when only one is known.

    ``places`` rounds the two-bound mean only (a single bound is returned as is).
    """
    mean = (low + high) / F.lit(2.0)
    if places is not None:
        mean = F.round(mean, places)
    return F.coalesce(mean, high.cast("double"), low.cast("double"))


def mass_ratio(weight: Column, height: Column, height_divisor: float = 1.0,
               places: int = 2) -> Column:
    """round(w / (h / d) ** 1.5, places); NULL when h <= 0 or either is NULL."""
    h = height / F.lit(float(height_divisor)) if height_divisor != 1.0 else height
    return F.when(height > 0, F.round(weight / F.pow(h, F.lit(1.5)), places))


def raw_mass_ratio(weight: Column, height: Column) -> Column:
    """Unrounded w / h ** 1.5 with no positivity guard; division by zero -> NULL."""
    return F.try_divide(weight, F.pow(height, F.lit(1.5)))


def flag_count(*flags: Column) -> Column:
    """Number of true flags, as bigint (flags are never NULL)."""
    return reduce(lambda a, b: a + b, [f.cast("bigint") for f in flags])


def completeness_fraction(*flags: Column, table=None, default: float = 0.0) -> Column:
    """Map the count of present flags to a fixed fraction table."""
    from traitlens.constants import METRIC_COMPLETENESS

    table = table or METRIC_COMPLETENESS
    n = flag_count(*flags)
    out = None
    for count, frac in table:
        out = (F.when(n == count, F.lit(float(frac))) if out is None
               else out.when(n == count, F.lit(float(frac))))
    return out.otherwise(F.lit(float(default)))


def list_length(text: Column, sep: str = ", ") -> Column:
    """Items in a delimited text, blanks counted; 0 when NULL. Bigint."""
    return (F.when(text.isNotNull(), F.size(F.split(text, sep)))
            .otherwise(F.lit(0)).cast("bigint"))


def share(count: Column, total: Column) -> Column:
    """count / total as double, 0.0 when total is 0."""
    return F.when(total > 0, count / total).otherwise(F.lit(0.0))
