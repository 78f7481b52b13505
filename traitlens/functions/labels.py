"""Banded and rule labels (BND-1..12) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from traitlens import constants as K
from traitlens.functions.ranges import is_open_low, is_present

_OPS = {
    "<=": lambda c, b: c <= b,
    "<": lambda c, b: c < b,
    ">=": lambda c, b: c >= b,
    ">": lambda c, b: c > b,
}


def band(value: Column, rules, default=None, rest=None) -> Column:
    """Label ``value`` by the first matching (op, bound, label) rule.

    ``rest`` is the label for any other non-NULL value, ``default`` the label
    for everything else (including NULL). Thresholds are compared as doubles.
    """
    out = None
    for op, bound, label in rules:
        cond = _OPS[op](value, F.lit(float(bound)))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if rest is not None:
        out = out.when(value.isNotNull(), F.lit(rest))
    return out.otherwise(F.lit(default)) if default is not None else out


def size_category(raw: Column, high: Column) -> Column:
    """BND-1 on the weight high bound: no weight -> NULL, open-low -> Very Small.

    A present weight whose high bound could not be read stays NULL.
    """
    banded = band(high, K.SIZE_BANDS, rest=K.SIZE_TOP)
    return (F.when(~is_present(raw), F.lit(None).cast("string"))
            .when(is_open_low(raw), F.lit(K.SIZE_OPEN_LOW))
            .otherwise(banded))


def longevity_category(avg_life: Column) -> Column:
    return band(avg_life, K.LONGEVITY_BANDS, default=K.LONGEVITY_DEFAULT)


def activity_level(group: Column) -> Column:
    out = None
    for groups, label in K.ACTIVITY_BY_GROUP:
        cond = group.isin(*groups)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(K.ACTIVITY_DEFAULT))


def family_friendliness(traits_raw: Column) -> Column:
    low = F.lower(traits_raw)
    return (F.when(traits_raw.isNotNull() & low.rlike(K.FAMILY_PATTERN), F.lit("Family-Friendly"))
            .when(traits_raw.isNotNull() & low.rlike(K.GUARD_PATTERN)
                  & ~low.rlike(K.GUARD_EXCLUDE_PATTERN), F.lit("Protective/Guardian"))
            .when(traits_raw.isNotNull(), F.lit("Moderate"))
            .otherwise(F.lit("Unknown")))


def build_type(raw_ratio: Column) -> Column:
    return band(raw_ratio, K.BUILD_BANDS, rest=K.BUILD_REST)


def weight_consistency(weight_span: Column) -> Column:
    return band(weight_span, K.WEIGHT_CONSISTENCY_BANDS, rest=K.CONSISTENCY_REST)


def height_consistency(height_span: Column) -> Column:
    return band(height_span, K.HEIGHT_CONSISTENCY_BANDS, rest=K.CONSISTENCY_REST)


def lifespan_predictability(life_span: Column) -> Column:
    return band(life_span, K.LIFESPAN_PREDICTABILITY_BANDS, rest=K.PREDICTABILITY_REST)


def temperament_complexity(total: Column) -> Column:
    return band(total, K.COMPLEXITY_BANDS, default=K.COMPLEXITY_DEFAULT)


# FIXED VALUES: the share thresholds of the two labels below.
def family_suitability(fam: Column, calm: Column, prot: Column, indep: Column) -> Column:
    s = K.SUITABILITY_LABELS
    return (F.when((fam >= 0.4) & (calm >= 0.2), F.lit(s[0]))
            .when((fam >= 0.3) | (calm >= 0.3), F.lit(s[1]))
            .when(fam >= 0.2, F.lit(s[2]))
            .when((prot >= 0.4) & (indep <= 0.3), F.lit(s[3]))
            .otherwise(F.lit(s[4])))


def training_difficulty(intel: Column, indep: Column) -> Column:
    t = K.TRAINING_LABELS
    return (F.when((intel >= 0.3) & (indep <= 0.2), F.lit(t[0]))
            .when((intel >= 0.2) & (indep <= 0.3), F.lit(t[1]))
            .when((intel >= 0.1) | (indep <= 0.4), F.lit(t[2]))
            .otherwise(F.lit(t[3])))


def primary_category(scores: dict[str, Column]) -> Column:
    """First category, in fixed priority order, whose score is the maximum and > 0."""
    ordered = [(scores[name], label) for name, label in K.PRIMARY_CATEGORIES]
    top = F.greatest(*[s for s, _ in ordered])
    out = None
    for s, label in ordered:
        cond = (top > 0) & (s == top)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(K.UNCLASSIFIED))
