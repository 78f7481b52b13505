"""Quality classifier: interpolated modified Kneser-Ney character n-grams from trusted text.

``classify`` scores with ``char_model``: real code points, tables that grow with
the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitlens.llm import char_model
from traitlens.llm.common import written

#: Quantile of the trusted texts' scores, per language, above which a text is rejected where no bad text is labelled.
QUANTILE = 0.995
#: Folds of the documents; a fold is scored by the model of all others.
FOLDS = 5

#: Tails of the trusted texts' scores from which the labels choose.
GRID = (0.9, 0.92, 0.94, 0.95, 0.96, 0.97, 0.975, 0.98, 0.985, 0.99, 0.9925, 0.995, 0.9975, 0.999, 1.0)


def limits(scored: DataFrame, quantile: float) -> DataFrame:
    """(l, most, most_passage) per language, and (every = true) for all, of (l, good, perplexity, passage) rows.

    Of all pairs of quantiles of the trusted texts' two scores, the pair that keeps
    the largest share of them and rejects the largest share of the others (sum of
    both); ties: the loosest. Where no other is labelled, the quantile.
    """
    tails = sorted({*GRID, quantile})
    rows = scored.select(F.explode(F.array(F.struct(F.lit(False).alias("every"), "l"),
                                           F.struct(F.lit(True).alias("every"), F.lit(None).cast("string").alias("l"))))
                         .alias("of"), "good", "perplexity", "passage").where("perplexity is not null")
    cuts = written(rows.where("good").groupBy("of").agg(
        *[F.percentile_approx(x, F.array(*map(F.lit, tails)), 10_000).alias(f"{x}_cuts") for x in ("perplexity", "passage")]), "cuts")

    def place(x: str) -> Column:
        return F.size(F.filter(f"{x}_cuts", lambda cut: cut < F.col(x))).alias(f"{x}_at")

    cells = rows.join(cuts, "of").select("of", "good", place("perplexity"), place("passage")) \
        .groupBy("of", "good", "perplexity_at", "passage_at").agg(F.count(F.lit(1)).alias("n"))
    # at most len(tails) ** 2 pairs, for as many cells at most
    a, b = (F.explode(F.sequence(F.lit(0), F.lit(len(tails) - 1))).alias(x) for x in "ab")
    kept = (F.col("perplexity_at") <= F.col("a")) & (F.col("passage_at") <= F.col("b"))
    part = lambda which: F.sum(F.when(which, F.col("n")).otherwise(0))
    pairs = cells.select("*", a).select("*", b).groupBy("of", "a", "b").agg(
        part(F.col("good") & kept).alias("right"), part(F.col("good")).alias("of_good"),
        part(~F.col("good") & ~kept).alias("wrong"), part(~F.col("good")).alias("of_bad"))
    usual = tails.index(quantile)
    gain = F.when(F.col("of_bad") > 0, F.col("right") / F.col("of_good") + F.col("wrong") / F.col("of_bad")) \
        .otherwise(((F.col("a") == usual) & (F.col("b") == usual)).cast("double"))
    best = pairs.groupBy("of").agg(F.max_by(F.struct("a", "b"), F.struct(gain, F.col("a") + F.col("b"), "a")).alias("best"))
    return best.join(cuts, "of").select("of.every", F.col("of.l").alias("l"), F.get("perplexity_cuts", F.col("best.a")).alias("most"),
                                        F.get("passage_cuts", F.col("best.b")).alias("most_passage"))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             trusted: str = "quality = 1 and toxic = 0", quantile: float = QUANTILE, folds: int = FOLDS) -> DataFrame:
    """One row (key, lang, n_symbols, perplexity, threshold, passage, passage_threshold, kept) per row of ``docs``.

    Documents are dealt to ``folds`` by a hash of the key; each is scored by the
    model of the trusted documents of all other folds, so every trusted document
    trains and sets thresholds. ``passage`` is the perplexity of the text's least
    likely passage; a text is kept if neither score is above its threshold. The
    labels choose a language's thresholds (``limits``); a language without trusted
    documents (and null) takes those of all. Null and empty texts have no
    perplexity and are not kept. Without trusted text every text with characters
    is kept. Repeated rows are scored each; null keys are never labelled.
    """
    ids = written(labels.select(F.col(key).alias("_id"), F.expr(f"({trusted})").alias("good"))
                  .where("_id is not null and good is not null").groupBy("_id").agg(F.max("good").alias("good")), "labelled")
    scored = char_model.perplexities(docs, ids.where("good"), folds, key, text, lang)
    bounds = written(limits(scored.join(ids, scored["k"] == ids["_id"]).select("l", "good", "perplexity", "passage"),
                            quantile), "limits")
    every = bounds.where("every").first()  # one row
    own = bounds.where("not every").select(F.col("l").alias("_l"), "most", "most_passage")
    rows = scored.join(own, scored["l"].eqNullSafe(own["_l"]), "left")
    for limit in ("most", "most_passage"):
        rows = rows.withColumn(limit, F.coalesce(limit, F.lit(every and every[limit]).cast("double")))
    kept = [F.coalesce(F.col(x) <= F.coalesce(limit, x), F.lit(False)) for x, limit in
            (("perplexity", "most"), ("passage", "most_passage"))]
    return rows.select(F.col("k").alias(key), F.col("l").alias(lang), "n_symbols", "perplexity",
                       F.col("most").alias("threshold"), "passage", F.col("most_passage").alias("passage_threshold"),
                       (kept[0] & kept[1]).alias("kept"))
