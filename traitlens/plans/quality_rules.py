"""The star's quality rules: 59 declarative rules over four models and the source.

Table names: raw (source), stg_profiles, dim_profiles, fct_metrics, dim_traits.
"""

from __future__ import annotations

from traitlens import constants as K
from traitlens.operators import quality as Q

_ORDER = "{lo} <= {hi} or {lo} is null or {hi} is null"
HEIGHT_ORDER = _ORDER.format(lo="height_min_inches", hi="height_max_inches")
LIFE_ORDER = _ORDER.format(lo="life_span_min_years", hi="life_span_max_years")
WEIGHT_ORDER = _ORDER.format(lo="weight_min_lbs", hi="weight_max_lbs")
COMPLETENESS_BOUNDS = "data_completeness_score >= 0 and data_completeness_score <= 4"

SCORE_COLUMNS = tuple(K.LEXICON_COLUMNS[n][1] for n in K.LEXICONS)


# FIXED VALUES: the columns under test, the bounds of ranges and the order expressions.
def star_rules() -> list[Q.Rule]:
    stg, dim, fct, trt = "stg_profiles", "dim_profiles", "fct_metrics", "dim_traits"
    rules = [
        Q.unique(stg, "breed_id"), Q.not_null(stg, "breed_id"),
        Q.not_null(stg, "breed_name"), Q.unique(stg, "breed_name"),
        Q.unique(stg, "_dlt_id"), Q.not_null(stg, "_dlt_id"),
        Q.not_null(stg, "extracted_at"), Q.not_null(stg, "extraction_date"),
        Q.accepted_range(stg, "height_min_inches", 0, 40), Q.accepted_range(stg, "height_max_inches", 0, 40),
        Q.accepted_range(stg, "height_min_cm", 0, 100), Q.accepted_range(stg, "height_max_cm", 0, 100),
        Q.accepted_range(stg, "life_span_min_years", 1, 25), Q.accepted_range(stg, "life_span_max_years", 1, 25),
        Q.not_null(stg, "has_weight_data"), Q.not_null(stg, "has_height_data"),
        Q.not_null(stg, "has_lifespan_data"), Q.not_null(stg, "has_temperament_data"),
        Q.expression_is_true(stg, "height_order", HEIGHT_ORDER),
        Q.expression_is_true(stg, "life_span_order", LIFE_ORDER),

        Q.unique(dim, "breed_id"), Q.not_null(dim, "breed_id"),
        Q.not_null(dim, "breed_name"), Q.unique(dim, "breed_name"),
        Q.accepted_values(dim, "breed_group", K.ACCEPTED_GROUPS),
        Q.accepted_values(dim, "size_category", K.ACCEPTED_SIZES),
        Q.accepted_values(dim, "longevity_category", K.ACCEPTED_LONGEVITY),
        Q.accepted_values(dim, "inferred_activity_level", K.ACCEPTED_ACTIVITY),
        Q.accepted_values(dim, "family_friendliness", K.ACCEPTED_FRIENDLINESS),
        Q.accepted_range(dim, "data_completeness_score", 0, 4),
        Q.expression_is_true(dim, "completeness_bounds", COMPLETENESS_BOUNDS),

        Q.not_null(fct, "breed_id"), Q.relationships(fct, "breed_id", dim, "breed_id"),
        Q.not_null(fct, "breed_name"),
        Q.accepted_values(fct, "build_type", K.ACCEPTED_BUILDS),
        Q.accepted_values(fct, "weight_consistency", K.ACCEPTED_CONSISTENCY),
        Q.accepted_values(fct, "height_consistency", K.ACCEPTED_CONSISTENCY),
        Q.accepted_values(fct, "lifespan_predictability", K.ACCEPTED_PREDICTABILITY),
        Q.accepted_range(fct, "metrics_completeness_score", 0, 1),
        Q.expression_is_true(fct, "weight_order", WEIGHT_ORDER),
        Q.expression_is_true(fct, "height_order", HEIGHT_ORDER),
        Q.expression_is_true(fct, "life_span_order", LIFE_ORDER),

        Q.not_null(trt, "breed_id"), Q.relationships(trt, "breed_id", dim, "breed_id"),
        Q.not_null(trt, "breed_name"),
        Q.accepted_range(trt, "total_traits", 0, 20),
        *[Q.accepted_range(trt, c, 0, 1) for c in SCORE_COLUMNS],
        Q.accepted_values(trt, "primary_temperament_category", K.ACCEPTED_PRIMARY),
        Q.accepted_values(trt, "temperament_complexity", K.ACCEPTED_COMPLEXITY),
        Q.accepted_values(trt, "family_suitability", K.SUITABILITY_LABELS),
        Q.accepted_values(trt, "training_difficulty", K.TRAINING_LABELS),
    ]
    return rules


def recency_rule() -> tuple[str, str, int]:
    """(table, column, days) of the source freshness rule."""
    return ("raw", "extracted_at", K.RECENCY_DAYS)
