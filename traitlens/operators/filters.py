"""Facet filters (FLT-2..7): optional selections -> one Column predicate.

Selections become Column predicates (``isin``, ``between``), never SQL
text, so there is nothing to quote. An empty selection adds no predicate.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conjunction(preds: list[Column]) -> Column:
    """AND of predicates; TRUE when there are none (Catalyst folds it away)."""
    return reduce(lambda a, b: a & b, preds, F.lit(True))


@dataclass(frozen=True)
class Filters:
    """Dashboard selections over the profile frame.

    ``weight_range=None`` means "the facet bounds": min/max of avg_weight_kg
    over the same frame, which every non-NULL weight satisfies (see
    ``profile_predicate``). The weight predicate is always
    applied, as on the dashboard, so NULL weights drop out unless
    ``keep_null_weight`` is set.
    """

    groups: tuple[str, ...] = ()
    sizes: tuple[str, ...] = ()
    suitability: tuple[str, ...] = ()
    weight_range: tuple[float, float] | None = None
    keep_null_weight: bool = False
    weight_column: str = "avg_weight_kg"
    extra: tuple = field(default_factory=tuple)

    def profile_predicate(self, profiles: DataFrame) -> Column:
        """Predicate on profile (dimension) columns: groups, sizes, weight."""
        preds: list[Column] = []
        if self.groups:
            preds.append(F.col("breed_group").isin(*self.groups))
        if self.sizes:
            preds.append(F.col("size_category").isin(*self.sizes))
        w = F.col(self.weight_column)
        if self.weight_range is None:
            # The default slider spans the facet bounds, i.e. min..max of this
            # same column over this same frame (widened when equal). Every
            # value lies inside but NULL and NaN, so no bounds job is needed.
            in_range = w.isNotNull() & ~F.isnan(w.cast("double"))
        else:
            lo, hi = F.lit(float(self.weight_range[0])), F.lit(float(self.weight_range[1]))
            in_range = w.between(lo, hi)
        preds.append(in_range | w.isNull() if self.keep_null_weight else in_range)
        preds.extend(self.extra)
        return conjunction(preds)

    def trait_predicate(self) -> Column:
        """Predicate on trait-dimension columns: family suitability."""
        if not self.suitability:
            return F.lit(True)
        return F.col("family_suitability").isin(*self.suitability)

    def apply(self, profiles: DataFrame, restrict_traits: bool = True) -> DataFrame:
        """Filter a profile frame; with ``restrict_traits`` also by suitability."""
        pred = self.profile_predicate(profiles)
        if restrict_traits:
            pred = pred & self.trait_predicate()
        return profiles.where(pred)
