"""Batch recommender (REC-1..4): request texts -> top profiles per request.

Scoring requests against profiles one by one is a product R x P. Instead:

1. each request reduces to an intent (size wish, apartment, family, active,
   calm, guard) -- at most 5 x 2^4 = 80 distinct intents exist;
2. each profile reduces to the signals the score reads (lower-cased size and
   suitability, light weight, long life, three trait hits) -- a bounded set
   of signatures; within a signature every profile scores the same for any
   intent, so only its first 5 names (by name, id) can reach a top 5;
3. signature tops x the fixed table of all 80 intents are scored and ranked
   per intent (bounded, independent of R and P);
4. requests join the <= 400 top rows on the intent code (equi-join).

Cost: one pass over profiles with a per-signature top-5 (partial
WindowGroupLimit before the shuffle) and one pass over requests.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitlens import constants as K
from traitlens.operators.aggregates import top_k_per_group

INTENT_COLUMNS = ("size_pref", "apartment", "family", "active", "calm", "guard")
SIGNAL_COLUMNS = ("sig_size", "sig_family", "sig_light", "sig_long_lived", "sig_active",
                  "sig_calm", "sig_guard")


def _any_contains(text: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def intent_columns(text: Column) -> dict[str, Column]:
    """REC-1: intent flags from request text (substring tests on lower-case text)."""
    t = F.lower(text)
    size = None
    for words, label in K.SIZE_WORDS:
        cond = _any_contains(t, words)
        size = F.when(cond, F.lit(label)) if size is None else size.when(cond, F.lit(label))
    return {
        "size_pref": size,
        "apartment": F.coalesce(t.contains(K.APARTMENT_WORD), F.lit(False)),
        "family": F.coalesce(_any_contains(t, K.FAMILY_WORDS), F.lit(False)),
        "active": F.coalesce(_any_contains(t, K.ACTIVE_WORDS), F.lit(False)),
        "calm": F.coalesce(_any_contains(t, K.CALM_WORDS), F.lit(False)),
        "guard": F.coalesce(_any_contains(t, K.GUARD_WORDS), F.lit(False)),
    }


def intent_code(cols: dict[str, Column] | None = None) -> Column:
    """A stable text key for an intent."""
    c = cols or {k: F.col(k) for k in INTENT_COLUMNS}
    return F.concat_ws("|", F.coalesce(c["size_pref"], F.lit("")),
                       *[c[k].cast("int").cast("string") for k in INTENT_COLUMNS[1:]])


def intent_rows() -> list[tuple]:
    """Every possible intent (80 rows) with its code, as Python tuples."""
    sizes = [None] + [label for _, label in K.SIZE_WORDS]
    rows = []
    for size, apt, fam, act, calm, guard in itertools.product(sizes, *[(False, True)] * 5):
        if apt and size != "small":      # 'apartment' is itself a small-size word
            continue
        flags = (apt, fam, act, calm, guard)
        code = "|".join([size or ""] + [str(int(b)) for b in flags])
        rows.append((size, *flags, code))
    return rows


def intent_table() -> Column:
    """Generator Column emitting the 80 fixed intents (one SQL expression)."""
    def lit(v):
        if v is None:
            return "cast(null as string)"
        if isinstance(v, bool):
            return "true" if v else "false"
        return "'" + v + "'"
    names = (*INTENT_COLUMNS, "intent")
    structs = ", ".join("named_struct(" + ", ".join(f"'{n}', {lit(v)}" for n, v in zip(names, row)) + ")"
                        for row in intent_rows())
    return F.expr(f"inline(array({structs}))")


def profile_signals(ctx: DataFrame, family_points: dict[str, int] | None = None) -> DataFrame:
    """REC-2 inputs per profile from a context frame (display columns, '' for NULL)."""
    size = F.lower(F.coalesce(F.col("size_category"), F.lit("")))
    traits = F.lower(F.coalesce(F.col("temperament_traits"), F.lit("")))
    w, life = F.col("avg_weight_kg"), F.col("avg_life_span_years")
    return ctx.withColumns({
        "sig_size": size,
        "sig_family": F.lower(F.coalesce(F.col("family_suitability"), F.lit(""))),
        "sig_light": F.coalesce(w <= K.APARTMENT_MAX_KG, F.lit(False)),
        "sig_long_lived": F.coalesce(life >= K.LIFESPAN_BONUS_YEARS, F.lit(False)),
        "sig_active": _any_contains(traits, K.ACTIVE_TRAITS),
        "sig_calm": _any_contains(traits, K.CALM_TRAITS),
        "sig_guard": _any_contains(traits, K.GUARD_TRAITS),
    })


def score(family_points: dict[str, int] | None = None) -> Column:
    """REC-2: points of a (signals, intent) pair."""
    p = K.POINTS
    fam_pts = family_points if family_points is not None else K.FAMILY_POINTS_LITERAL
    fam = F.lit(0)
    for label, pts in fam_pts.items():
        fam = F.when(F.col("sig_family") == label, F.lit(pts)).otherwise(fam)
    terms = [
        F.when(F.col("size_pref").isNotNull() & F.col("sig_size").contains(F.col("size_pref")), p["size"]),
        F.when(F.col("apartment") & F.col("sig_size").isin(*K.APARTMENT_SIZES), p["apartment_size"]),
        F.when(F.col("apartment") & F.col("sig_light"), p["apartment_weight"]),
        F.when(F.col("family"), fam),
        F.when(F.col("active") & F.col("sig_active"), p["active"]),
        F.when(F.col("calm") & F.col("sig_calm"), p["calm"]),
        F.when(F.col("guard") & F.col("sig_guard"), p["guard"]),
        F.when(F.col("sig_long_lived"), p["lifespan"]),
    ]
    total = F.lit(0)
    for t in terms:
        total = total + F.coalesce(t, F.lit(0))
    return total.cast("bigint")


def top_per_intent(ctx: DataFrame, k: int = K.SUGGESTIONS_PER_REQUEST,
                   family_points: dict[str, int] | None = None) -> DataFrame:
    """REC-3: the k suggestions of every possible intent.

    Keeps positive scores only, unless no top-k profile scores above 0, in
    which case the first k are kept. Output: intent, suggestion_rank,
    profile display columns, score.
    """
    signals = profile_signals(ctx)
    per_sig = top_k_per_group(signals, list(SIGNAL_COLUMNS),
                              [F.asc("breed_name"), F.asc("breed_id")], k, rank_col="_sig_rank")
    # Every signature row meets every intent of the fixed 80-row table: a
    # bounded generator (not a join with data), then equi-joins only.
    paired = per_sig.select("*", intent_table()).withColumn("score", score(family_points))
    ranked = top_k_per_group(paired, "intent", [F.desc("score"), F.asc("breed_name"), F.asc("breed_id")],
                             k, rank_col="suggestion_rank")
    best = F.max("score").over(_intent_window())
    return (ranked.withColumn("_best", best)
            .where((F.col("score") > 0) | (F.col("_best") <= 0)).drop("_best"))


def _intent_window():
    from pyspark.sql import Window
    return Window.partitionBy("intent")


def requests_with_intent(requests: DataFrame, text: str) -> DataFrame:
    cols = intent_columns(F.col(text))
    return requests.withColumns(cols).withColumn("intent", intent_code())


def recommend(requests: DataFrame, text: str, ctx: DataFrame, key: str,
              k: int = K.SUGGESTIONS_PER_REQUEST, family_points: dict[str, int] | None = None) -> DataFrame:
    """Suggestion rows per request: (key, suggestion_rank, breed_id, breed_name, score)."""
    tops = top_per_intent(ctx, k, family_points).select("intent", "suggestion_rank", "breed_id",
                                                        "breed_name", "score")
    req = requests_with_intent(requests, text).select(key, "intent")
    # tops has at most 80 x k rows by construction: broadcast is size-bounded.
    return req.join(F.broadcast(tops), "intent").select(
        key, F.col("suggestion_rank").cast("bigint").alias("suggestion_rank"), "breed_id", "breed_name", "score")


def _num_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("nan"))


def suggestion_line() -> Column:
    """REC-4: one text line per suggestion."""
    return F.concat(
        F.lit("- "), F.col("breed_name"), F.lit(": size="), F.col("size_category"),
        F.lit(", weight≈"), _num_text(F.col("avg_weight_kg")), F.lit("kg, lifespan≈"),
        _num_text(F.col("avg_life_span_years")), F.lit("y, family="), F.col("family_suitability"),
        F.lit("; temperament: "), F.col("temperament_traits"))


def recommend_text(requests: DataFrame, text: str, ctx: DataFrame, key: str,
                   k: int = K.SUGGESTIONS_PER_REQUEST, family_points: dict[str, int] | None = None) -> DataFrame:
    """REC-4: per request, prefix line, suggestion lines and suffix line joined by newlines."""
    tops = top_per_intent(ctx, k, family_points).withColumn("line", suggestion_line())
    per_intent = tops.groupBy("intent").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("suggestion_rank", "line"))),
                                 lambda x: x["line"]), "\n").alias("body"))
    msg = per_intent.select("intent", F.concat_ws("\n", F.lit(K.REC_PREFIX), F.col("body"),
                                                  F.lit(K.REC_SUFFIX)).alias("suggestions"))
    req = requests_with_intent(requests, text).select(key, text, "intent")
    # an intent has no message only if no profile is left: then every request gets the same answer
    return req.join(F.broadcast(msg), "intent", "left").select(
        key, text, F.coalesce("suggestions", F.lit(K.REC_EMPTY)).alias("suggestions"))
