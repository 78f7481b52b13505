"""Filters, aggregates and reports."""

from pyspark.sql import functions as F

from traitlens.operators import aggregates as A
from traitlens.operators.filters import Filters
from traitlens.plans import reports as R


def test_slider_bounds_fixups(spark):
    empty = spark.createDataFrame([], "w double")
    assert tuple(A.slider_bounds(empty, "w").first()) == (0.0, 100.0)
    same = spark.createDataFrame([(0.5,), (0.5,)], "w double")
    assert tuple(A.slider_bounds(same, "w").first()) == (0.0, 1.5)
    normal = spark.createDataFrame([(2.0,), (9.0,), (None,)], "w double")
    assert tuple(A.slider_bounds(normal, "w").first()) == (2.0, 9.0)


def test_filters_drop_null_weights_unless_kept(inputs):
    prof = inputs.profiles
    with_null = prof.where(F.col("avg_weight_kg").isNull()).count()
    assert with_null > 0
    assert Filters().apply(prof).where(F.col("avg_weight_kg").isNull()).count() == 0
    kept = Filters(keep_null_weight=True).apply(prof).where(F.col("avg_weight_kg").isNull()).count()
    assert kept == with_null


def test_filters_are_conjunctive(inputs):
    f = Filters(groups=("Toy",), sizes=("Small", "Medium"), weight_range=(0.0, 1000.0))
    got = f.apply(inputs.profiles).select("breed_group", "size_category").distinct().collect()
    assert {r.breed_group for r in got} <= {"Toy"}
    assert {r.size_category for r in got} <= {"Small", "Medium"}


def test_top_k_per_group_is_bounded_and_ordered(spark):
    df = spark.createDataFrame([("a", 3.0, "x"), ("a", 3.0, "b"), ("a", 1.0, "c"), ("b", 5.0, "z")],
                               "g string, s double, n string")
    got = A.ordered_names(df, "g", "n", [F.desc("s"), F.asc("n")], 2, "top").orderBy("g").collect()
    assert [(r.g, r.top) for r in got] == [("a", "b, x"), ("b", "z")]


def test_top_k_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    plan = A.top_k_per_group(df, "g", [F.desc("v")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_mode_ties_pick_smallest(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "c")], "u long, e string")
    got = {r.u: r.m for r in A.modal_value(df, "u", "e", "m").collect()}
    assert got == {1: "a", 2: "c"}


def test_longest_lived_is_top_k(inputs):
    out = R.longest_lived(inputs.profiles, Filters(weight_range=(0.0, 1000.0)), k=5).collect()
    assert len(out) == 5
    vals = [r.avg_life_span_years for r in out]
    assert vals == sorted(vals, reverse=True)


def test_freshness_counts_hour_boundaries(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1, 10, 59),)], "ts timestamp_ntz")
    out = R.freshness({"t": (df, "ts")}, dt.datetime(2025, 1, 1, 11, 1)).first()
    assert out.hours_since_update == 1


def test_top_traits_on_stored_marts_equals_fused(inputs):
    from traitlens.plans import star as S

    f = Filters(sizes=("Small", "Medium"), suitability=("Good for Families", "Moderate for Families"),
                weight_range=(0.0, 1000.0))
    fused = R.top_traits(inputs.profiles, f).collect()
    stored = R.top_traits_stored(S.dim_profiles(inputs.stg), S.dim_traits(inputs.stg), f).collect()
    assert [tuple(r) for r in fused] == [tuple(r) for r in stored]


def test_dimension_join_broadcasts_only_with_proven_bound(spark):
    from traitlens.operators.joins import dimension_join

    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # only explicit hints broadcast
    try:
        fact = spark.range(1000).select((F.col("id") % 50).alias("k"))
        small = spark.range(50).withColumnRenamed("id", "k")
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan(dimension_join(fact, small, "k"))
        assert "BroadcastHashJoin" in plan(dimension_join(fact, small, "k", bounded_rows=50))
        assert dimension_join(fact, small, "k").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_excerpt_of_an_empty_context_and_of_a_hot_segment(spark):
    from traitlens import constants as K
    from traitlens.plans.context import grounding_excerpt

    schema = ("breed_id long, breed_name string, breed_group string, size_category string, avg_weight_kg double, "
              "avg_life_span_years double, family_suitability string, temperament_traits string")
    empty = grounding_excerpt(spark.createDataFrame([], schema), max_rows=80).collect()
    assert [(r.n_rows, r.excerpt) for r in empty] == [(0, K.EXCERPT_EMPTY)]
    hot = spark.range(3000).select(F.col("id").alias("breed_id"), F.format_string("n%05d", "id").alias("breed_name"),
                                   F.lit("g").alias("breed_group"), F.lit("s").alias("size_category"),
                                   F.lit(1.0).alias("avg_weight_kg"), F.lit(1.0).alias("avg_life_span_years"),
                                   F.lit("f").alias("family_suitability"), F.lit("t").alias("temperament_traits"))
    row = grounding_excerpt(hot, max_rows=3).first()
    assert row.n_rows == 3000 and row.excerpt.count("- breed: ") == 3 and "2997 more rows" in row.excerpt
    assert [f"n0000{i}" in row.excerpt for i in range(4)] == [True, True, True, False]


def test_context_is_uncapped_unless_asked(inputs):
    from traitlens.plans.context import context_frame, context_table

    assert context_table(inputs.profiles).count() == context_frame(inputs.profiles).count()
    assert context_table(inputs.profiles, limit=5).count() == 5
