"""Aggregation operators (AGG-1..12, ORD-1..3).

Skew rule: a single group may hold a third of all rows. Everything here is
either a partial+final hash aggregate (map-side combine, so a hot group
ships one partial row per task) or a ranked window whose ``rank <= k``
filter Spark turns into a partial WindowGroupLimit before the exchange, so
each task ships at most k rows per group. No operator collects a whole
group into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_small(df: DataFrame, *order) -> DataFrame:
    """ORDER BY for results of a few aggregated rows.

    The result rows move to one partition by an exchange of their own, so the
    work below stays parallel, and are sorted there without the sampling job of
    a global sort. Use ``orderBy`` for unbounded results.
    """
    return df.repartition(1).sortWithinPartitions(*order)


def top_k_per_group(df: DataFrame, group: list[str] | str, order: list[Column], k: int,
                    rank_col: str = "rank", salt: str | None = None, salts: int = 64) -> DataFrame:
    """Rows ranked 1..k within each group by ``order`` (ORD-3).

    ``order`` must end in a unique key for deterministic ties. With ``salt``
    (a column spread over a group's rows) the first k of each of ``salts``
    shares of a group are kept first, so the task that ranks a hot group gets
    at most k * salts rows instead of k per input task.
    """
    groups = [group] if isinstance(group, str) else list(group)
    if salt is not None:
        share = F.pmod(F.xxhash64(salt), F.lit(salts))
        first = Window.partitionBy(*groups, "_share").orderBy(*order)
        df = (df.withColumn("_share", share).withColumn("_first", F.row_number().over(first))
              .where(F.col("_first") <= k).drop("_share", "_first"))
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def ordered_names(df: DataFrame, group: list[str] | str, name: str, order: list[Column],
                  k: int, alias: str, sep: str = ", ") -> DataFrame:
    """Top-k values of ``name`` per group joined into one text (AGG-4).

    Equivalent to ``STRING_AGG(name, sep ORDER BY ... LIMIT k)``. The list per
    group holds at most k entries, so collecting it is bounded.
    """
    groups = [group] if isinstance(group, str) else list(group)
    ranked = top_k_per_group(df, groups, order, k, rank_col="_rk", salt=name)
    return (ranked.groupBy(*groups)
            .agg(F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct(F.col("_rk"), F.col(name)))),
                            lambda x: x[name]), sep).alias(alias)))


def modal_value(df: DataFrame, group: list[str] | str, value: str, alias: str) -> DataFrame:
    """Most frequent non-NULL ``value`` per group; ties -> smallest value (AGG-6).

    ``mode`` keeps a value->count map per group and merges partial maps, so
    its state is bounded by the number of distinct values, not by rows.
    """
    groups = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*groups).agg(F.mode(F.col(value), deterministic=True).alias(alias))


def slider_bounds(df: DataFrame, column: str, default_low: float = 0.0,
                  default_high: float = 100.0) -> DataFrame:
    """One-row (min_w, max_w) of a measure with the dashboard's fix-ups (AGG-11).

    Missing bounds take the defaults; reversed bounds are swapped; equal
    bounds are widened by one on each side (the low side not below 0).
    """
    c = F.col(column)
    agg = df.where(c.isNotNull()).agg(F.min(c).cast("double").alias("lo"),
                                     F.max(c).cast("double").alias("hi"))
    lo0 = F.coalesce(F.col("lo"), F.lit(default_low))
    hi0 = F.coalesce(F.col("hi"), F.lit(default_high))
    lo1, hi1 = F.least(lo0, hi0), F.greatest(lo0, hi0)
    same = lo1 == hi1
    return agg.select(
        F.when(same, F.greatest(F.lit(0.0), lo1 - F.lit(1.0))).otherwise(lo1).alias("min_w"),
        F.when(same, hi1 + F.lit(1.0)).otherwise(hi1).alias("max_w"),
    )
