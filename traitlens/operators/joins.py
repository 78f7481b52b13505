"""Join operators (JN-1..7) with an explicit size rule for broadcasting.

Spark's planner already broadcasts a side whose estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-plans with runtime
sizes, so the default here is to let it decide. ``dimension_join``
broadcasts only when the caller states a row bound that holds by
construction (``bounded_rows``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner", *,
                   bounded_rows: int | None = None) -> DataFrame:
    """Join a fact to a dimension; broadcast the dimension only with a proven bound.

    ``bounded_rows``: the caller guarantees the dimension never exceeds this
    many rows (e.g. a fixed code table).
    """
    return fact.join(F.broadcast(dim) if bounded_rows is not None else dim, on, how)


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` (JN-4), as a left-anti join."""
    return left.join(right, on, "left_anti")


def semi_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` with a match in ``right``; never duplicates left rows (JN-6)."""
    return left.join(right, on, "left_semi")


def latest_only(df: DataFrame, column: str, of: DataFrame | None = None) -> DataFrame:
    """Rows whose ``column`` equals its maximum: an uncorrelated scalar subquery (JN-7).

    ``of`` is the frame whose maximum counts, by default ``df``; name the
    narrow source of a wide frame, so the subquery reads one column.
    """
    return df.where(F.col(column) == (df if of is None else of).select(F.max(column)).scalar())

