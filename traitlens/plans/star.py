"""Staging and the three marts, all 1:1 on breed_id (SNK-3, SNK-4, SNK-7).

Every mart is a narrow projection of staging: building the whole star needs
no shuffle. Reports that the source model writes as ``dim JOIN traits
USING (breed_id)`` read ``profile_frame`` instead when the marts are derived
in the same job: one projection carrying both column sets, which is exactly
that 1:1 inner join without exchanging the data twice. When the marts are
stored tables, ``join_marts`` joins them (bucketed by breed_id: no shuffle).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitlens.functions import labels, measures, ranges, traits
from traitlens.session import per_context

STAGING_COLUMNS = (
    "breed_id", "breed_name", "_dlt_load_id", "_dlt_id", "extracted_at", "extraction_date",
    "bred_for", "breed_group", "origin", "country_code",
    "weight_min_lbs", "weight_max_lbs", "weight_min_kg", "weight_max_kg",
    "height_min_inches", "height_max_inches", "height_min_cm", "height_max_cm",
    "life_span_min_years", "life_span_max_years",
    "temperament_raw", "description", "history", "reference_image_id",
    "size_category", "has_weight_data", "has_height_data", "has_lifespan_data",
    "has_temperament_data", "parse_error",
)


#: Staging columns read out of range texts, and those that derive from them.
BOUNDS = ("weight_min_lbs", "weight_max_lbs", "weight_min_kg", "weight_max_kg", "height_min_inches",
          "height_max_inches", "height_min_cm", "height_max_cm", "life_span_min_years", "life_span_max_years")
MEASURED = (*BOUNDS, "size_category", "parse_error")


def stage(raw: DataFrame, *, nan: str = "null", strict: bool = False, measures: bool = True) -> DataFrame:
    """Clean the flattened raw table (PRJ-1..5, FLT-1, RNG-1..7, BND-1).

    ``parse_error`` (ours) is true when some measure text is present but
    unreadable; the source model aborts the whole build on such text.
    Every range text is parsed once: the bounds of a row come out of one
    generator (one output row per input row), and filters on bounds or labels
    reference its output, so Catalyst cannot substitute the parsers into
    them. Spark cannot prune a generator either; ``measures=False`` leaves it
    and the columns of ``MEASURED`` out.
    """
    rows = raw.where(F.col("id").cast("bigint").isNotNull() & F.trim("name").isNotNull())
    if measures:
        rows = rows.select("*", F.inline(F.array(F.struct(
            *[col.alias(name) for name, col in bound_columns(nan, strict).items()]))))
    return rows.select(*[col.alias(name) for name, col in staging_columns(strict).items()
                         if measures or name not in MEASURED])


@per_context
def bound_columns(nan: str = "null", strict: bool = False) -> dict[str, Column]:
    """The bounds over the flattened raw columns."""
    c = F.col
    pairs = [ranges.parse_range(c("weight__imperial"), open_low=True, nan=nan, strict=strict),
             ranges.parse_range(c("weight__metric"), nan=nan, strict=strict),
             ranges.parse_range(c("height__imperial"), nan=nan, strict=strict),
             ranges.parse_range(c("height__metric"), nan=nan, strict=strict),
             ranges.parse_years(c("life_span"), strict=strict)]
    return dict(zip(BOUNDS, (bound for pair in pairs for bound in pair)))


@per_context
def staging_columns(strict: bool = False) -> dict[str, Column]:
    """Staging columns over the flattened raw columns and the bounds."""
    c = F.col
    to_ts = (lambda x: x.cast("timestamp")) if strict else (lambda x: x.try_cast("timestamp"))
    to_date = (lambda x: x.cast("date")) if strict else (lambda x: x.try_cast("date"))
    texts = [("weight__imperial", True), ("weight__metric", True), ("height__imperial", False),
             ("height__metric", False), ("life_span", False)]
    errors = [ranges.range_parse_error(c(text), c(low), c(high), sentinel=sentinel)
              for (text, sentinel), low, high in zip(texts, BOUNDS[::2], BOUNDS[1::2])]
    parse_error = errors[0]
    for e in errors[1:]:
        parse_error = parse_error | e
    temperament = c("temperament")
    cols: dict[str, Column] = {
        "breed_id": c("id").cast("bigint"),
        "breed_name": F.trim(c("name")),
        "_dlt_load_id": c("_dlt_load_id"),
        "_dlt_id": c("_dlt_id"),
        "extracted_at": to_ts(c("extracted_at")),
        "extraction_date": to_date(c("extraction_date")),
        "bred_for": F.trim(c("bred_for")),
        "breed_group": F.trim(c("breed_group")),
        "origin": F.trim(c("origin")),
        "country_code": F.trim(c("country_code")),
        **{name: c(name) for name in BOUNDS},
        "temperament_raw": F.nullif(F.trim(temperament), F.lit("")),
        "description": F.trim(c("description")),
        "history": F.trim(c("history")),
        "reference_image_id": F.trim(c("reference_image_id")),
        "size_category": labels.size_category(c("weight__imperial"), c("weight_max_lbs")),
        "has_weight_data": ranges.is_present(c("weight__imperial")),
        "has_height_data": ranges.is_present(c("height__imperial"), sentinel=False),
        "has_lifespan_data": ranges.is_present(c("life_span"), sentinel=False),
        "has_temperament_data": ranges.is_present(temperament, sentinel=False),
        "parse_error": parse_error,
    }
    return cols


def _averages(places: int | None) -> dict[str, Column]:
    c = F.col
    return {
        "avg_weight_lbs": measures.midpoint(c("weight_min_lbs"), c("weight_max_lbs"), places),
        "avg_weight_kg": measures.midpoint(c("weight_min_kg"), c("weight_max_kg"), places),
        "avg_height_inches": measures.midpoint(c("height_min_inches"), c("height_max_inches"), places),
        "avg_height_cm": measures.midpoint(c("height_min_cm"), c("height_max_cm"), places),
        "avg_life_span_years": measures.midpoint(c("life_span_min_years"), c("life_span_max_years"), places),
    }


@per_context
def dim_columns() -> dict[str, Column]:
    """Profile dimension over staging columns (MSR-3,6,8, BND-2..4)."""
    c = F.col
    avg = _averages(places=1)
    flags = [c("has_weight_data"), c("has_height_data"), c("has_lifespan_data"),
             c("has_temperament_data")]
    return {
        "breed_id": c("breed_id"), "breed_name": c("breed_name"),
        "breed_group": c("breed_group"), "bred_for": c("bred_for"),
        "origin": c("origin"), "country_code": c("country_code"),
        "size_category": c("size_category"),
        **avg,
        "temperament_raw": c("temperament_raw"),
        "temperament_trait_count": measures.list_length(c("temperament_raw")),
        "longevity_category": labels.longevity_category(avg["avg_life_span_years"]),
        "inferred_activity_level": labels.activity_level(c("breed_group")),
        "family_friendliness": labels.family_friendliness(c("temperament_raw")),
        "description": c("description"), "history": c("history"),
        "reference_image_id": c("reference_image_id"),
        "has_weight_data": flags[0], "has_height_data": flags[1],
        "has_lifespan_data": flags[2], "has_temperament_data": flags[3],
        "data_completeness_score": measures.flag_count(*flags),
        "extracted_at": c("extracted_at"), "extraction_date": c("extraction_date"),
    }


#: Dimension columns beyond staging's that need no bounds.
UNMEASURED_DIM = ("temperament_trait_count", "inferred_activity_level", "family_friendliness",
                  "data_completeness_score")


def dim_profiles(stg: DataFrame) -> DataFrame:
    return stg.select(*[v.alias(k) for k, v in dim_columns().items()])


@per_context
def fct_columns() -> dict[str, Column]:
    """Metrics fact over staging columns (MSR-1,2,4,5,7, BND-5..8)."""
    c = F.col
    avg = _averages(places=None)
    spans = {
        "weight_range_lbs": measures.span(c("weight_min_lbs"), c("weight_max_lbs")),
        "weight_range_kg": measures.span(c("weight_min_kg"), c("weight_max_kg")),
        "height_range_inches": measures.span(c("height_min_inches"), c("height_max_inches")),
        "height_range_cm": measures.span(c("height_min_cm"), c("height_max_cm")),
        "life_span_range_years": measures.span(c("life_span_min_years"), c("life_span_max_years")),
    }
    flags = [c("has_weight_data"), c("has_height_data"), c("has_lifespan_data")]
    w, h = avg["avg_weight_lbs"], avg["avg_height_inches"]
    return {
        "breed_id": c("breed_id"), "breed_name": c("breed_name"),
        "weight_min_lbs": c("weight_min_lbs"), "weight_max_lbs": c("weight_max_lbs"),
        "weight_range_lbs": spans["weight_range_lbs"],
        "weight_min_kg": c("weight_min_kg"), "weight_max_kg": c("weight_max_kg"),
        "weight_range_kg": spans["weight_range_kg"],
        "height_min_inches": c("height_min_inches"), "height_max_inches": c("height_max_inches"),
        "height_range_inches": spans["height_range_inches"],
        "height_min_cm": c("height_min_cm"), "height_max_cm": c("height_max_cm"),
        "height_range_cm": spans["height_range_cm"],
        "life_span_min_years": c("life_span_min_years"), "life_span_max_years": c("life_span_max_years"),
        "life_span_range_years": spans["life_span_range_years"],
        **avg,
        "weight_height_ratio_imperial": measures.mass_ratio(w, h),
        "weight_height_ratio_metric": measures.mass_ratio(avg["avg_weight_kg"], avg["avg_height_cm"],
                                                          height_divisor=100.0),
        "build_type": labels.build_type(measures.raw_mass_ratio(w, h)),
        "weight_consistency": labels.weight_consistency(spans["weight_range_lbs"]),
        "height_consistency": labels.height_consistency(spans["height_range_inches"]),
        "lifespan_predictability": labels.lifespan_predictability(spans["life_span_range_years"]),
        "has_weight_data": flags[0], "has_height_data": flags[1], "has_lifespan_data": flags[2],
        "metrics_completeness_score": measures.completeness_fraction(*flags),
        "extracted_at": c("extracted_at"), "extraction_date": c("extraction_date"),
    }


def fct_metrics(stg: DataFrame) -> DataFrame:
    return stg.select(*[v.alias(k) for k, v in fct_columns().items()])


def _with_items(stg: DataFrame) -> DataFrame:
    # All trait measures of a row come out of one generator (exactly one
    # output row per input row). Filters on trait labels reference generator
    # output, so Catalyst evaluates them above the Generate on computed
    # columns instead of inlining the array lambdas into the scan once per
    # reference (a Filter gets no common-subexpression elimination).
    return stg.select("*", F.inline(F.array(traits.trait_stats(F.col("temperament_raw")))))


@per_context
def trait_columns() -> dict[str, Column]:
    """Trait dimension columns over the generated trait measures (TRT-1..5, MSR-9, BND-9..12)."""
    from traitlens import constants as K

    fields = (["total_traits", "trait_array"] + [K.LEXICON_COLUMNS[n][1] for n in K.LEXICONS]
              + [K.LEXICON_COLUMNS[n][0] for n in K.LEXICONS]
              + ["primary_temperament_category", "temperament_complexity", "family_suitability",
                 "training_difficulty"])
    out: dict[str, Column] = {"breed_id": F.col("breed_id"), "breed_name": F.col("breed_name"),
                              "temperament_raw": F.col("temperament_raw")}
    out.update({f: F.col(f) for f in fields})
    return out


def dim_traits(stg: DataFrame) -> DataFrame:
    return _with_items(stg).select(*[v.alias(k) for k, v in trait_columns().items()])


def profile_frame(stg: DataFrame, fct_columns: dict[str, str] | None = None) -> DataFrame:
    """Profile dimension and trait dimension columns in one narrow projection.

    Equal to ``dim JOIN traits USING (breed_id)`` because both marts are 1:1
    projections of the same staging rows; no exchange is planned.
    ``fct_columns`` adds metrics-fact columns as {output name: fact column},
    which likewise replaces a join with the fact.
    """
    dim = dim_columns()
    trait = {k: v for k, v in trait_columns().items() if k not in dim}
    fct = {}
    if fct_columns:
        all_fct = globals()["fct_columns"]()
        fct = {out: all_fct[src] for out, src in fct_columns.items()}
    return _with_items(stg).select(*[v.alias(k) for k, v in {**dim, **trait, **fct}.items()])


def is_column(name: str) -> bool:
    """Whether some model of the star has a column of this name."""
    return name in STAGING_COLUMNS or any(name in d() for d in (dim_columns, trait_columns, fct_columns))


def frame(raw: DataFrame, columns: Iterable[str], fct_columns: dict[str, str] | None = None) -> DataFrame:
    """The given columns of staging, dimension, fact and trait mart over raw rows, as narrow as they allow.

    The marts are 1:1 projections of staging, so this equals their join on
    breed_id. Range texts are parsed and traits scored only if a column asks
    for it. Same-named columns agree across the marts except the fact's
    unrounded averages, which ``fct_columns`` gives as {output name: fact column}.
    """
    dim, trait, fct = dim_columns(), trait_columns(), globals()["fct_columns"]()
    chosen: dict[str, Column] = {}
    measured, scored = bool(fct_columns), False
    for name in columns:
        if name in STAGING_COLUMNS:
            chosen[name] = F.col(name)
            measured |= name in MEASURED
        elif name in trait:
            chosen[name] = trait[name]
            scored = True
        elif name in dim:
            chosen[name] = dim[name]
            measured |= name not in UNMEASURED_DIM
        elif name in fct:
            chosen[name] = fct[name]
            measured = True
        else:
            raise ValueError(f"no mart has a column {name!r}")
    chosen.update({out: fct[src] for out, src in (fct_columns or {}).items()})
    rows = stage(raw, measures=measured)
    return (_with_items(rows) if scored else rows).select(*[v.alias(k) for k, v in chosen.items()])


def join_marts(dim: DataFrame, traits_df: DataFrame) -> DataFrame:
    """``dim JOIN traits USING (breed_id)`` over stored marts (JN-1).

    Stored marts are bucketed and sorted by breed_id (see sinks), so the join
    reads co-partitioned buckets without an exchange.
    """
    extra = [c for c in traits_df.columns if c not in dim.columns or c == "breed_id"]
    return dim.join(traits_df.select(*extra), "breed_id")


def build_star(raw: DataFrame, *, nan: str = "null", strict: bool = False) -> dict[str, DataFrame]:
    """Staging and the three marts, in dependency order (SNK-7)."""
    stg = stage(raw, nan=nan, strict=strict)
    return {
        "stg_profiles": stg,
        "dim_profiles": dim_profiles(stg),
        "fct_metrics": fct_metrics(stg),
        "dim_traits": dim_traits(stg),
    }
