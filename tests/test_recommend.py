"""Recommender: intents (FIXTURES F5) and batch result vs brute force."""

from pyspark.sql import functions as F

from traitlens import constants as K
from traitlens.operators import recommend as REC
from traitlens.operators.filters import Filters
from traitlens.plans.context import context_frame

F5 = [
    ("I live in an apartment and want a calm, small dog. Any suggestions?", "small", True, False, False, True, False),
    ("We have young kids and enjoy weekend hikes. Which breeds fit?", None, False, True, True, False, False),
    ("Looking for a medium-sized, low-shedding dog with a long lifespan.", "medium", False, False, False, False, False),
    ("A giant dog to guard and protect the house", "large", False, False, False, False, True),
    ("toy or large, either is fine", "small", False, False, False, False, False),
    ("my dog should grunt less", None, False, False, True, False, False),
]


def test_intents_from_request_texts(spark):
    df = spark.createDataFrame([(t[0],) for t in F5], "text string")
    got = df.select(*[c.alias(k) for k, c in REC.intent_columns(F.col("text")).items()]).collect()
    assert [tuple(r) for r in got] == [t[1:] for t in F5]


def test_intent_table_has_80_rows():
    rows = REC.intent_rows()
    assert len(rows) == 80 and len({r[-1] for r in rows}) == 80


# (intent, what a profile must have, points): the scoring rules as a table
POINT_RULES = [
    ("size", "size", 3), ("apartment", "small or medium", 2), ("apartment", "light", 2),
    ("family", "family high", 3), ("family", "family medium", 2),
    ("active", "active", 2), ("calm", "calm", 2), ("guard", "guard", 2), ("always", "long-lived", 1),
]


def _signals(row, size_pref):
    text, size = row["temperament_traits"].lower(), row["size_category"].lower()
    kg, years = row["avg_weight_kg"], row["avg_life_span_years"]
    found = {f"family {row['family_suitability'].lower()}"}
    found |= {"size"} if size_pref and size_pref in size else set()
    found |= {"small or medium"} if size in ("small", "medium") else set()
    found |= {"light"} if kg is not None and kg <= 15 else set()
    found |= {"long-lived"} if years is not None and years >= 12 else set()
    for signal, words in (("active", "energetic active athletic"), ("calm", "calm,gentle,laid back,quiet"),
                          ("guard", "protective alert confident")):
        if any(w in text for w in (words.split(",") if "," in words else words.split())):
            found.add(signal)
    return found


def _expected(ctx_rows, intent, points=POINT_RULES):
    size_pref, *flags = intent
    wanted = {"always", "size"} | {n for n, f in zip(("apartment", "family", "active", "calm", "guard"), flags) if f}
    ranked = sorted((-sum(p for i, s, p in points if i in wanted and s in _signals(r, size_pref)), r["breed_name"])
                    for r in ctx_rows)[:5]
    positive = [(n, -s) for s, n in ranked if s]
    return positive or [(n, -s) for s, n in ranked]


def test_batch_recommender_equals_rule_table(spark, inputs):
    ctx = context_frame(inputs.profiles, Filters())
    ctx_rows = [r.asDict() for r in ctx.collect()]
    req = spark.createDataFrame([(i, t[0]) for i, t in enumerate(F5)], "rid long, text string")
    got = REC.recommend(req, "text", ctx, "rid").orderBy("rid", "suggestion_rank").collect()
    for i, t in enumerate(F5):
        assert [(r.breed_name, r.score) for r in got if r.rid == i] == _expected(ctx_rows, t[1:]), t[0]


def test_family_points_reach_the_score(spark, inputs):
    ctx = context_frame(inputs.profiles, Filters())
    req = spark.createDataFrame([(0, "a dog for kids")], "rid long, text string")
    points = {"excellent for families": 3, "good for families": 2}
    top = REC.recommend(req, "text", ctx, "rid", family_points=points).first()
    assert top.score >= 3


def test_empty_context_answers_every_request(spark, inputs):
    ctx = context_frame(inputs.profiles, Filters()).where("false")
    req = spark.createDataFrame([(0, F5[0][0]), (1, "")], "rid long, text string")
    got = REC.recommend_text(req, "text", ctx, "rid").collect()
    assert {r.rid: r.suggestions for r in got} == {0: K.REC_EMPTY, 1: K.REC_EMPTY}


def test_recommend_text_lines(spark, inputs):
    ctx = context_frame(inputs.profiles, Filters())
    req = spark.createDataFrame([(0, F5[0][0])], "rid long, text string")
    msg = REC.recommend_text(req, "text", ctx, "rid").first().suggestions
    lines = msg.split("\n")
    assert lines[0] == K.REC_PREFIX and lines[-1] == K.REC_SUFFIX
    assert 1 <= len(lines) - 2 <= 5 and all(x.startswith("- ") for x in lines[1:-1])
