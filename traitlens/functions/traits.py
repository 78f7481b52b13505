"""Trait lists and lexicon scoring, array form (TRT-1..6, MSR-9, BND-9..12).

The array form works per row: split -> trim -> drop blanks, then count
lexicon hits with higher-order array functions. It needs no shuffle and
cannot fan out on duplicate keys. The explode form for inputs that arrive
one item per row lives in ``traitlens.operators.traits``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from traitlens import constants as K
from traitlens.functions import labels
from traitlens.functions.measures import share

SEPARATOR = ", "


def items(text: Column, sep: str = SEPARATOR) -> Column:
    """Trimmed, non-blank items of a delimited text; [] when NULL."""
    parts = F.filter(F.transform(F.split(text, sep), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def _member_of(lexicon):
    """One-argument predicate (PySpark reads a lambda's arity)."""
    return lambda x: x.isin(*lexicon)


def trait_stats(text: Column, lexicons=None) -> Column:
    """All trait measures of one delimited text as ONE struct column.

    Nested lambdas bind the item array, its lower-cased form and the counts
    once per row; scores and labels are arithmetic over those bound values.
    Output columns then read fields of this struct, so a filter that Catalyst
    pushes below the projection inlines the struct once, not the item
    pipeline once per score reference.
    Fields: total_traits, trait_array, <score columns>, <count columns>, labels.
    """
    lexicons = lexicons or K.LEXICONS
    names = {n: K.LEXICON_COLUMNS[n] for n in lexicons}

    def measures(arr: Column) -> Column:
        def from_low(low: Column) -> Column:
            return F.struct(
                F.size(arr).cast("bigint").alias("total_traits"),
                F.array_sort(arr).alias("trait_array"),
                *[F.size(F.filter(low, _member_of(lex))).cast("bigint").alias(names[n][0])
                  for n, lex in lexicons.items()])
        return F.transform(F.array(F.transform(arr, lambda x: F.lower(x))), from_low)[0]

    def finish(c: Column) -> Column:
        total = c["total_traits"]
        scores = {n: share(c[names[n][0]], total) for n in lexicons}
        labelled = score_labels(scores, total)
        return F.struct(
            total.alias("total_traits"), c["trait_array"].alias("trait_array"),
            *[scores[n].alias(names[n][1]) for n in lexicons],
            *[c[names[n][0]].alias(names[n][0]) for n in lexicons],
            *[col.alias(k) for k, col in labelled.items()])

    counted = F.transform(F.array(items(text)), measures)[0]
    return F.transform(F.array(counted), finish)[0]


def score_labels(score: dict[str, Column], total: Column) -> dict[str, Column]:
    """The four labels of the trait dimension from score columns."""
    return {
        "primary_temperament_category": labels.primary_category(score),
        "temperament_complexity": labels.temperament_complexity(total),
        "family_suitability": labels.family_suitability(
            score["family"], score["calm"], score["protective"], score["independent"]),
        "training_difficulty": labels.training_difficulty(
            score["intelligence"], score["independent"]),
    }


def traits_text(arr: Column, sep: str = SEPARATOR) -> Column:
    """Array to text (TRT-6)."""
    return F.array_join(arr, sep)
