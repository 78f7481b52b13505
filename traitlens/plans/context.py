"""Recommendation context and grounding excerpts (RPT-19, RPT-20, PRJ-6, TRT-6).

The context is the filtered profile set with display columns. The
suitability selection annotates rather than restricts: a profile whose
suitability is not selected keeps its row but loses its suitability and
trait text, as the source model's left join to a filtered trait table does
(``mode="restrict"`` drops such profiles instead).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlens import constants as K
from traitlens.functions.traits import traits_text
from traitlens.operators.aggregates import top_k_per_group
from traitlens.operators.filters import Filters

CONTEXT_COLUMNS = ("breed_name", "breed_group", "size_category", "avg_weight_kg",
                   "avg_life_span_years", "family_suitability", "temperament_traits")


def context_frame(profiles: DataFrame, filters: Filters = Filters(), mode: str = "annotate",
                  keep_id: bool = True) -> DataFrame:
    """All filtered profiles with display columns ('' for NULL text)."""
    rows = profiles.where(filters.profile_predicate(profiles))
    keep = filters.trait_predicate()
    if mode == "restrict":
        rows, keep = rows.where(keep), F.lit(True)
    elif mode != "annotate":
        raise ValueError("mode must be 'annotate' or 'restrict'")
    blank = F.lit("")
    cols = [
        F.col("breed_name"),
        F.coalesce(F.col("breed_group"), blank).alias("breed_group"),
        F.coalesce(F.col("size_category"), blank).alias("size_category"),
        F.col("avg_weight_kg"), F.col("avg_life_span_years"),
        F.coalesce(F.when(keep, F.col("family_suitability")), blank).alias("family_suitability"),
        F.coalesce(F.when(keep, traits_text(F.col("trait_array"))), blank).alias("temperament_traits"),
    ]
    if keep_id:
        cols.insert(0, F.col("breed_id"))
    return rows.select(*cols)


def context_table(profiles: DataFrame, filters: Filters = Filters(), mode: str = "annotate",
                  limit: int | None = None) -> DataFrame:
    """RPT-19: context rows, with ``limit`` the first so many by name (a top-k: TakeOrderedAndProject)."""
    ctx = context_frame(profiles, filters, mode)
    if limit is not None:
        ctx = ctx.orderBy("breed_name", "breed_id").limit(limit)
    return ctx.select(*CONTEXT_COLUMNS)


def _num_text(c):
    return F.coalesce(c.cast("string"), F.lit("nan"))


def excerpt_line():
    """One formatted context row."""
    return F.concat(
        F.lit("- breed: "), F.col("breed_name"), F.lit("; group: "), F.col("breed_group"),
        F.lit("; size: "), F.col("size_category"),
        F.lit("; avg_weight_kg: "), _num_text(F.col("avg_weight_kg")),
        F.lit("; avg_lifespan_years: "), _num_text(F.col("avg_life_span_years")),
        F.lit("; family_suitability: "), F.col("family_suitability"),
        F.lit("; temperament_traits: "), F.col("temperament_traits"))


def grounding_excerpt(ctx: DataFrame, segment: str = "breed_group",
                      *, max_rows: int) -> DataFrame:
    """RPT-20 per segment: header, first ``max_rows`` lines by name, and a remainder line.

    Output: (segment, n_rows, excerpt). Each segment's text holds at most
    ``max_rows`` lines, ranked in two levels (see ``top_k_per_group``) and
    formatted after ranking; the row count is a partial aggregate. A context
    without rows gives one row: segment '', 0 and the empty text.
    """
    first = top_k_per_group(ctx, segment, [F.asc("breed_name"), F.asc("breed_id")], max_rows, "_rk",
                            salt="breed_id").withColumn("line", excerpt_line())
    body = first.groupBy(segment).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rk", "line"))),
                                 lambda x: x["line"]), "\n").alias("body"))
    counts = ctx.groupBy(segment).agg(F.count(F.lit(1)).alias("n_rows"))
    more = F.when(F.col("n_rows") > max_rows,
                  F.format_string("… and %d more rows not shown", F.col("n_rows") - max_rows))
    found = (counts.join(body, counts[segment].eqNullSafe(body[segment]))
             .select(counts[segment], "n_rows",
                     F.concat_ws("\n", *[F.lit(h) for h in K.EXCERPT_HEAD], F.col("body"), more)
                     .alias("excerpt")))
    nothing = (ctx.agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows = 0")
               .select(F.lit("").alias(segment), "n_rows", F.lit(K.EXCERPT_EMPTY).alias("excerpt")))
    return found.unionByName(nothing)
