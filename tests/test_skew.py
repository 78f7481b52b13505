"""Skew: one key holds a third of all rows. Results stay exact and plans stay bounded."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from traitlens.operators import aggregates as A
from traitlens.operators import quality as Q
from traitlens.operators.traits import lexicon_counts, lexicon_shares

N = 30_000
TYPES = ["view", "click", "signup", "purchase", "error"]


@pytest.fixture(scope="module")
def skewed(spark):
    # user 0 owns every third row; the rest spread over 500 users
    return (spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(1 + F.col("id") % 500).alias("user_id"),
        F.element_at(F.array(*[F.lit(t) for t in TYPES]), (F.col("id") % 7 % 5 + 1).cast("int")).alias("event_type"),
        (F.col("id") * 7919 % 1000).cast("double").alias("value"))
        .repartition(16))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_holds_a_third(skewed):
    top = skewed.groupBy("user_id").count().orderBy(F.desc("count")).first()
    assert top.user_id == 0 and top["count"] == N // 3


def test_top_k_exact_under_skew(skewed):
    got = A.top_k_per_group(skewed, "user_id", [F.desc("value"), F.asc("event_type")], 3)
    hot = [(r.value, r.event_type) for r in got.where("user_id = 0").orderBy("rank").collect()]
    rows = [(r.value, r.event_type) for r in skewed.where("user_id = 0").collect()]
    want = sorted(rows, key=lambda x: (-x[0], x[1]))[:3]
    assert hot == want
    assert "WindowGroupLimit" in _plan(got)          # partial limit before the shuffle


def test_mode_and_shares_exact_under_skew(skewed):
    rows = [(r.user_id, r.event_type) for r in skewed.where("user_id = 0").collect()]
    counts = Counter(e for _, e in rows)
    best = max(counts.values())
    want_mode = min(e for e, c in counts.items() if c == best)
    got = A.modal_value(skewed, "user_id", "event_type", "m").where("user_id = 0").first().m
    assert got == want_mode
    lex = {"engagement": ("view", "click")}
    shares = lexicon_shares(
        lexicon_counts(skewed.withColumnRenamed("event_type", "item"), ["user_id"], "item", lex,
                       {"engagement": "eng"}, total="total"),
        lex, {"engagement": "eng"}, {"engagement": "eng_share"}, total="total")
    hot = shares.where("user_id = 0").first()
    assert hot.total == len(rows)
    assert hot.eng == counts["view"] + counts["click"]
    assert "partial_count" in _plan(shares)            # map-side combine: one partial row per task


def test_relationships_plan_is_pre_aggregated_anti_join(spark, skewed):
    parent = spark.range(1, 400).withColumnRenamed("id", "user_id")
    orphans = Q.orphan_keys(skewed, parent, Q.relationships("e", "user_id", "u", "user_id"))
    got = {r.child_key: r.n_rows for r in orphans.collect()}
    assert got[0] == N // 3 and all(k == 0 or k >= 400 for k in got)
    plan = _plan(orphans)
    assert "LeftAnti" in plan and "partial_count" in plan
