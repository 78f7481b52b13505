"""Trait scoring, explode form (TRT-1, TRT-2, TRT-4, TRT-5, AGG-5).

For inputs that already arrive one item per row (e.g. events), or that must
be unnested: explode -> trim -> drop blanks -> partial+final hash aggregate
per key. Counting is a ``count_if`` per lexicon, so the shuffled state per
key is a fixed handful of counters however many items the key has. The
sorted item array is only built when asked and only for keys whose items
come from one row (a profile's own trait text), which bounds it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlens import constants as K
from traitlens.functions import traits as T
from traitlens.functions.measures import share


def explode_items(df: DataFrame, keys: list[str], text: str, sep: str = ", ",
                  item: str = "item") -> DataFrame:
    """One row per trimmed, non-blank item; rows with a NULL text are dropped (TRT-1)."""
    return (df.where(F.col(text).isNotNull())
            .select(*keys, F.explode(F.split(F.col(text), sep)).alias("_raw_item"))
            .select(*keys, F.trim("_raw_item").alias(item))
            .where(F.col(item) != ""))


def lexicon_counts(items: DataFrame, keys: list[str], item: str, lexicons: dict[str, tuple],
                   names: dict[str, str], total: str = "total") -> DataFrame:
    """Per key: item total and lexicon hit counts (TRT-2, TRT-4), bigint."""
    low = F.lower(F.col(item))
    return items.groupBy(*keys).agg(
        F.count(F.col(item)).alias(total),
        *[F.count_if(low.isin(*lex)).alias(names[n]) for n, lex in lexicons.items()])


def lexicon_shares(counts: DataFrame, lexicons: dict[str, tuple], count_names: dict[str, str],
                   share_names: dict[str, str], total: str = "total") -> DataFrame:
    """Add count/total shares, 0.0 when the total is 0 (MSR-9)."""
    return counts.withColumns({share_names[n]: share(F.col(count_names[n]), F.col(total))
                               for n in lexicons})


def trait_dimension_exploded(stg: DataFrame) -> DataFrame:
    """The trait dimension computed by unnest + group + left join back (TRT-5).

    Same result as the array form in ``plans.star.dim_traits`` on unique
    keys (guarded by the unique rule on breed_id); kept as the reference
    implementation of the explode form. Its sorted item array collects one
    key's items, which is bounded only because keys are unique; for inputs
    with repeated keys use the counts (``lexicon_counts``), never the array.
    """
    keys = ["breed_id"]
    items = explode_items(stg, keys, "temperament_raw", item="trait")
    count_names = {n: K.LEXICON_COLUMNS[n][0] for n in K.LEXICONS}
    share_names = {n: K.LEXICON_COLUMNS[n][1] for n in K.LEXICONS}
    low = F.lower(F.col("trait"))
    agg = items.groupBy(*keys).agg(
        F.count("trait").alias("total_traits"),
        F.sort_array(F.collect_list("trait")).alias("trait_array"),
        *[F.count_if(low.isin(*lex)).alias(count_names[n]) for n, lex in K.LEXICONS.items()])
    base = stg.select("breed_id", "breed_name", "temperament_raw")
    joined = base.join(agg, keys, "left")
    zero = F.lit(0).cast("bigint")
    filled = joined.select(
        "breed_id", "breed_name", "temperament_raw",
        F.coalesce("total_traits", zero).alias("total_traits"),
        F.coalesce("trait_array", F.array().cast("array<string>")).alias("trait_array"),
        *[F.coalesce(count_names[n], zero).alias(count_names[n]) for n in K.LEXICONS])
    scored = lexicon_shares(filled, K.LEXICONS, count_names, share_names, total="total_traits")
    scores = {n: F.col(share_names[n]) for n in K.LEXICONS}
    labelled = scored.withColumns(T.score_labels(scores, F.col("total_traits")))
    order = (["breed_id", "breed_name", "temperament_raw", "total_traits", "trait_array"]
             + [share_names[n] for n in K.LEXICONS] + [count_names[n] for n in K.LEXICONS]
             + ["primary_temperament_category", "temperament_complexity", "family_suitability",
                "training_difficulty"])
    return labelled.select(*order)
