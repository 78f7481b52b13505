"""Trait lists and lexicon scoring (FIXTURES F2 traits; array vs explode form)."""

import itertools

from pyspark.sql import functions as F

from traitlens import constants as K
from traitlens.functions import labels
from traitlens.operators.traits import trait_dimension_exploded
from traitlens.plans import star as S


def _stg(spark, texts):
    return spark.createDataFrame([(i, f"n{i}", t) for i, t in enumerate(texts)],
                                 "breed_id bigint, breed_name string, temperament_raw string")


def test_trait_edge_rows(spark):
    texts = [None, "Gentle, Calm", "Friendly, , Calm", "Calm, calm", "Gentle", "Eager"]
    out = S.dim_traits(_stg(spark, texts)).orderBy("breed_id").collect()
    assert [r.total_traits for r in out] == [0, 2, 2, 2, 1, 1]
    assert [r.trait_array for r in out] == [[], ["Calm", "Gentle"], ["Calm", "Friendly"], ["Calm", "calm"],
                                            ["Gentle"], ["Eager"]]
    gentle = out[4]
    assert (gentle.social_score, gentle.calm_score, gentle.family_friendliness_score) == (1.0, 1.0, 1.0)
    assert gentle.primary_temperament_category == "Social/Friendly"
    eager = out[5]
    assert (eager.energy_score, eager.working_score) == (1.0, 1.0)
    assert out[3].calm_traits_count == 2          # case-insensitive match
    assert out[0].primary_temperament_category == "Unclassified"
    assert out[0].temperament_complexity == "Minimal"


def _sequential_primary(s):
    """Category rule as written in the model: each branch compares with later ones only."""
    names = [n for n, _ in K.PRIMARY_CATEGORIES]
    for i, n in enumerate(names):
        if all(s[n] >= s[m] for m in names[i + 1:]) and s[n] > 0:
            return dict(K.PRIMARY_CATEGORIES)[n]
    return K.UNCLASSIFIED


def test_primary_category_matches_sequential_rule(spark):
    names = [n for n, _ in K.PRIMARY_CATEGORIES]
    tuples = list(itertools.product(range(4), repeat=len(names)))
    df = spark.createDataFrame(tuples, ", ".join(f"{n} int" for n in names))
    got = df.select(*names, labels.primary_category({n: F.col(n) for n in names}).alias("p")).collect()
    assert len(got) == 4 ** 6
    for r in got:
        assert r.p == _sequential_primary({n: r[n] for n in names})


def test_array_form_equals_explode_form(inputs):
    a = S.dim_traits(inputs.stg)
    b = trait_dimension_exploded(inputs.stg)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_scores_within_unit_interval(inputs):
    t = S.dim_traits(inputs.stg)
    cols = [K.LEXICON_COLUMNS[n][1] for n in K.LEXICONS]
    bad = t.where(" or ".join(f"{c} < 0 or {c} > 1" for c in cols)).count()
    assert bad == 0


def test_array_form_has_no_exchange(inputs):
    plan = S.dim_traits(inputs.stg)._jdf.queryExecution().executedPlan().toString()
    # the only exchange allowed is the input spread of a single-split scan
    assert plan.count("Exchange") <= 1
    assert "hashpartitioning(breed_id" not in plan
