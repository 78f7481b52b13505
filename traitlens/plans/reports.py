"""Reports and user-level queries over the star (RPT-1..18).

``profiles`` is the profile frame (dimension + trait columns, 1:1 on
breed_id); ``fct`` the metrics fact. Grouped reports group by label columns
with a handful of values, so each is a partial+final aggregate; top-k name
lists are bounded per group (see ``operators.aggregates``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitlens.operators import aggregates as A
from traitlens.operators.filters import Filters


def _avg(c: str, places: int) -> Column:
    return F.round(F.avg(c), places)


# --------------------------------------------------------------- dashboard
def longest_lived(profiles: DataFrame, filters: Filters = Filters(), k: int = 10) -> DataFrame:
    """RPT-1: top-k by average life span under the filters."""
    rows = filters.apply(profiles, restrict_traits=False).where(F.col("avg_life_span_years").isNotNull())
    return (rows.select("breed_name", "avg_life_span_years")
            .orderBy(F.desc("avg_life_span_years"), F.asc("breed_name")).limit(k))


def size_distribution(profiles: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """RPT-2: profile count per size band under the filters."""
    rows = filters.apply(profiles, restrict_traits=False)
    return A.order_small(rows.groupBy("size_category").agg(F.count(F.lit(1)).alias("breed_count")),
                         F.desc("breed_count"), F.asc_nulls_first("size_category"))


def top_traits(profiles: DataFrame, filters: Filters = Filters(), k: int = 15) -> DataFrame:
    """RPT-3: most frequent traits among filtered profiles (TRT-7, JN-5, JN-6, AGG-9)."""
    rows = (filters.apply(profiles, restrict_traits=True)
            .where(F.col("total_traits") > 0)
            .select(F.explode("trait_array").alias("trait")))
    return (rows.groupBy(F.lower(F.trim("trait")).alias("temperament_trait"))
            .agg(F.count(F.lit(1)).alias("occurrences"))
            .orderBy(F.desc("occurrences"), F.asc("temperament_trait")).limit(k))


def top_traits_stored(dim: DataFrame, traits: DataFrame, filters: Filters = Filters(),
                      k: int = 15) -> DataFrame:
    """RPT-3 over stored marts: trait rows restricted to the filtered profiles.

    The filtered dimension only supplies keys, so it is a semi-join (JN-6):
    trait rows are never duplicated. Stored marts are bucketed by breed_id,
    so the semi-join reads co-partitioned buckets.
    """
    from traitlens.operators.joins import semi_join

    keys = dim.where(filters.profile_predicate(dim)).select("breed_id")
    rows = (semi_join(traits.where(filters.trait_predicate() & (F.col("total_traits") > 0)), keys, "breed_id")
            .select(F.explode("trait_array").alias("trait")))
    return (rows.groupBy(F.lower(F.trim("trait")).alias("temperament_trait"))
            .agg(F.count(F.lit(1)).alias("occurrences"))
            .orderBy(F.desc("occurrences"), F.asc("temperament_trait")).limit(k))


# --------------------------------------------------------------- analyses
def family_by_size(profiles: DataFrame) -> DataFrame:
    """RPT-4: family-suited profiles per size band, with the top-3 names."""
    fam = profiles.where(F.col("family_suitability").isin("Excellent for Families", "Good for Families"))
    stats = fam.groupBy("size_category").agg(
        F.count(F.lit(1)).alias("breed_count"),
        _avg("family_friendliness_score", 2).alias("avg_family_score"))
    names = A.ordered_names(fam, "size_category", "breed_name",
                            [F.desc("family_friendliness_score"), F.asc("breed_name")], 3, "top_breeds")
    return A.order_small(stats.join(names, stats["size_category"].eqNullSafe(names["size_category"]))
                         .select(F.lit("Family-Friendly Breeds by Size").alias("analysis_type"),
                                 stats["size_category"], "breed_count", "avg_family_score", "top_breeds"),
                         F.desc("avg_family_score"))


def longevity_by_group(profiles: DataFrame) -> DataFrame:
    """RPT-5."""
    rows = profiles.where(F.col("avg_life_span_years").isNotNull())
    return A.order_small(rows.groupBy("breed_group").agg(
        F.count(F.lit(1)).alias("breed_count"),
        _avg("avg_life_span_years", 1).alias("avg_lifespan"),
        F.min("avg_life_span_years").alias("min_lifespan"),
        F.max("avg_life_span_years").alias("max_lifespan"))
        .select(F.lit("Longevity by Breed Group").alias("analysis_type"), "*"), F.desc("avg_lifespan"))


def training_scores(profiles: DataFrame) -> DataFrame:
    """RPT-6: training difficulty vs scores, with two example names."""
    stats = profiles.groupBy("training_difficulty").agg(
        F.count(F.lit(1)).alias("breed_count"),
        _avg("intelligence_score", 2).alias("avg_intelligence_score"),
        _avg("independent_score", 2).alias("avg_independence_score"))
    names = A.ordered_names(profiles, "training_difficulty", "breed_name",
                            [F.desc("intelligence_score"), F.asc("breed_name")], 2, "example_breeds")
    return A.order_small(stats.join(names, "training_difficulty")
                         .select(F.lit("Training Analysis").alias("analysis_type"), "training_difficulty",
                                 "breed_count", "avg_intelligence_score", "avg_independence_score",
                                 "example_breeds"), F.desc("avg_intelligence_score"))


def _has_build():
    """``build_type IS NOT NULL`` in terms of its inputs: the mass ratio is null exactly
    when a mean is null or the height 0. Pushed below a derived fact, this inlines the
    range parser four times instead of once per band and bound."""
    h = F.col("avg_height_inches")
    return F.col("avg_weight_lbs").isNotNull() & h.isNotNull() & (h != 0)


def build_stats(fct: DataFrame) -> DataFrame:
    """RPT-7: physical characteristics by build type (rounded)."""
    return (fct.where(_has_build()).groupBy("build_type").agg(
        F.count(F.lit(1)).alias("breed_count"),
        _avg("avg_weight_lbs", 1).alias("avg_weight_lbs"),
        _avg("avg_height_inches", 1).alias("avg_height_inches"),
        _avg("weight_height_ratio_imperial", 2).alias("avg_weight_height_ratio"))
        .select(F.lit("Physical Characteristics").alias("analysis_type"), "*")
        .transform(lambda d: A.order_small(d, F.desc("avg_weight_lbs"))))


SCORE_SUM = ("social_score", "energy_score", "intelligence_score", "protective_score",
             "independent_score", "calm_score")


def complexity_mode(profiles: DataFrame) -> DataFrame:
    """RPT-8: complexity with the modal primary category (AGG-6, AGG-8)."""
    total = sum((F.col(c) for c in SCORE_SUM[1:]), F.col(SCORE_SUM[0]))
    return (profiles.groupBy("temperament_complexity").agg(
        F.count(F.lit(1)).alias("breed_count"),
        F.round(F.avg("total_traits"), 1).alias("avg_traits"),
        F.round(F.avg(total), 2).alias("avg_total_score"),
        F.mode("primary_temperament_category", deterministic=True).alias("most_common_category"))
        .select(F.lit("Temperament Complexity").alias("analysis_type"), "*")
        .transform(lambda d: A.order_small(d, F.desc("avg_traits"))))


def quality_summary(profiles: DataFrame) -> DataFrame:
    """RPT-9: one-row completeness summary (AGG-3, AGG-7)."""
    return profiles.agg(
        F.lit("Data Quality Summary").alias("analysis_type"),
        F.lit("Overall").alias("category"),
        F.count(F.lit(1)).alias("total_breeds"),
        F.count_if("has_weight_data").alias("breeds_with_weight"),
        F.count_if("has_height_data").alias("breeds_with_height"),
        F.count_if("has_lifespan_data").alias("breeds_with_lifespan"),
        F.count_if("has_temperament_data").alias("breeds_with_temperament"),
        F.round(F.avg("data_completeness_score"), 2).alias("avg_completeness_score"))


# --------------------------------------------------------------- documented queries
def family_search(profiles: DataFrame, size: str = "Small",
                  suitability: str = "Excellent for Families") -> DataFrame:
    """RPT-10: family search by size, ordered by life span."""
    return (profiles.where((F.col("size_category") == size) & (F.col("family_suitability") == suitability))
            .select("breed_name", "size_category", "avg_life_span_years", "family_suitability")
            .orderBy(F.desc("avg_life_span_years"), F.asc("breed_name")))


def family_search_light(profiles: DataFrame, max_lbs: float = 50.0,
                        suitability: str = "Excellent for Families") -> DataFrame:
    """RPT-11: family search under a weight limit."""
    return (profiles.where((F.col("avg_weight_lbs") <= max_lbs) & (F.col("family_suitability") == suitability))
            .select("breed_name", "avg_weight_lbs", "size_category", "avg_life_span_years",
                    "family_friendliness_score", "training_difficulty", "primary_temperament_category")
            .orderBy("avg_weight_lbs", "breed_name"))


def build_averages(fct: DataFrame, places: int = 6) -> DataFrame:
    """RPT-12: physical averages by build type.

    Averages are rounded to ``places`` (default 6) so results do not depend on
    the order in which partitions are summed.
    """
    return (fct.where(_has_build()).groupBy("build_type").agg(
        F.count(F.lit(1)).alias("breed_count"),
        _avg("avg_weight_lbs", places).alias("avg_weight"),
        _avg("avg_height_inches", places).alias("avg_height"),
        _avg("avg_life_span_years", places).alias("avg_lifespan"))
        .transform(lambda d: A.order_small(d, F.desc("avg_weight"))))


def complexity_by_group(profiles: DataFrame, places: int = 6) -> DataFrame:
    """RPT-13: trait complexity by group, profiles with trait data only."""
    return (profiles.where(F.col("has_temperament_data")).groupBy("breed_group").agg(
        _avg("total_traits", places).alias("avg_temperament_complexity"),
        _avg("intelligence_score", places).alias("avg_intelligence"),
        _avg("family_friendliness_score", places).alias("avg_family_score"),
        F.count(F.lit(1)).alias("breed_count"))
        .transform(lambda d: A.order_small(d, F.desc("avg_temperament_complexity"))))


# --------------------------------------------------------------- monitoring
def freshness(sources: dict[str, tuple[DataFrame, str]], now: _dt.datetime) -> DataFrame:
    """RPT-14: newest timestamp per table and whole hours since it, as of ``now``.

    Hours count hour boundaries crossed (both ends truncated to the hour).
    One global aggregate per table, then a union of one-row results.
    """
    now_lit = F.lit(now).cast("timestamp_ntz")
    parts = []
    for name, (df, ts) in sources.items():
        parts.append(df.agg(F.max(F.col(ts).cast("timestamp_ntz")).alias("last_update"))
                     .select(F.lit(name).alias("model_name"), "last_update",
                             now_lit.alias("check_timestamp"),
                             F.timestamp_diff("HOUR", F.date_trunc("hour", "last_update"),
                                              F.date_trunc("hour", now_lit)).alias("hours_since_update")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def metric_report(df: DataFrame, metrics: list[tuple[str, Column]], now: _dt.datetime) -> DataFrame:
    """RPT-15: (metric, value, measured_at) rows; bigint and double values -> double.

    All metrics are aggregates over ``df`` computed in ONE pass, then
    unpivoted into one row per metric.
    """
    now_lit = F.lit(now).cast("timestamp_ntz")
    one = df.agg(*[m.cast("double").alias(f"m{i}") for i, (_, m) in enumerate(metrics)])
    rows = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(f"m{i}").alias("value"))
                     for i, (name, _) in enumerate(metrics)])
    return one.select(F.inline(rows)).withColumn("measured_at", now_lit)


def loads_per_day(df: DataFrame, ts: str, date_col: str | None = None) -> DataFrame:
    """RPT-16 / AGG-12: record count and newest time per load date."""
    d = F.col(date_col) if date_col else F.to_date(F.col(ts))
    return (df.groupBy(d.alias("load_date"))
            .agg(F.count(F.lit(1)).alias("record_count"), F.max(ts).alias("latest_record"))
            .orderBy(F.desc("load_date")))


# --------------------------------------------------------------- facets
FACETS = ("breed_group", "size_category", "family_suitability")


def facet_values(profiles: DataFrame, facets=FACETS) -> DataFrame:
    """RPT-18: distinct non-empty values of the facets, one (facet, value) row each.

    One scan: every row emits a (facet, value) pair per facet, then one
    distinct (a partial+final aggregate bounded by the facet cardinalities).
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in facets])
    return (profiles.select(F.inline(pairs))
            .where(F.col("value").isNotNull() & (F.col("value") != "")).distinct())


def facet_bounds(profiles: DataFrame) -> DataFrame:
    """RPT-18: slider bounds for the weight facet."""
    return A.slider_bounds(profiles, "avg_weight_kg")
