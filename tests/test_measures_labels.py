"""Measures and banded labels (FIXTURES F2: midpoints, ratios, bands)."""

from pyspark.sql import functions as F

from traitlens.functions import labels, measures


def one(spark, col, schema, row):
    return spark.createDataFrame([row], schema).select(col.alias("v")).first().v


def test_midpoints_rounded_and_not(spark):
    schema = "lo double, hi double"
    assert one(spark, measures.midpoint(F.col("lo"), F.col("hi"), 1), schema, (9.0, 11.5)) == 10.3
    assert one(spark, measures.midpoint(F.col("lo"), F.col("hi")), schema, (9.0, 11.5)) == 10.25
    assert one(spark, measures.midpoint(F.col("lo"), F.col("hi"), 1), schema, (None, 12.0)) == 12.0
    assert one(spark, measures.midpoint(F.col("lo"), F.col("hi"), 1), schema, (7.0, None)) == 7.0
    assert one(spark, measures.midpoint(F.col("lo"), F.col("hi"), 1), schema, (None, None)) is None


def test_midpoint_of_bigints_is_double(spark):
    v = one(spark, measures.midpoint(F.col("lo"), F.col("hi")), "lo bigint, hi bigint", (10, 13))
    assert v == 11.5


def test_ratio_and_build(spark):
    schema = "w double, h double"
    assert one(spark, measures.mass_ratio(F.col("w"), F.col("h")), schema, (65.0, 23.0)) == 0.59
    assert one(spark, labels.build_type(measures.raw_mass_ratio(F.col("w"), F.col("h"))), schema,
               (65.0, 23.0)) == "Very Lean Build"
    # zero height: ratio guarded, build type has no guard -> division by zero -> NULL
    assert one(spark, measures.mass_ratio(F.col("w"), F.col("h")), schema, (10.0, 0.0)) is None
    assert one(spark, labels.build_type(measures.raw_mass_ratio(F.col("w"), F.col("h"))), schema,
               (10.0, 0.0)) is None
    assert one(spark, labels.build_type(measures.raw_mass_ratio(F.col("w"), F.col("h"))), schema,
               (40.0, 1.0)) == "Heavy Build"
    assert one(spark, measures.mass_ratio(F.col("w"), F.col("h"), 100.0), schema, (30.0, 50.0)) == \
        round(30.0 / (0.5 ** 1.5), 2)


def test_consistency_bands(spark):
    got = [one(spark, labels.weight_consistency(F.col("s")), "s double", (v,)) for v in (10.0, 30.0, 31.0, None)]
    assert got == ["Consistent Size", "Moderate Variation", "High Variation", None]
    got = [one(spark, labels.lifespan_predictability(F.col("s")), "s bigint", (v,)) for v in (2, 4, 5, None)]
    assert got == ["Predictable Lifespan", "Moderate Variation", "High Variation", None]


def test_completeness(spark):
    schema = "a boolean, b boolean, c boolean"
    f = measures.completeness_fraction(F.col("a"), F.col("b"), F.col("c"))
    assert [one(spark, f, schema, r) for r in [(True, True, True), (True, True, False),
                                               (False, True, False), (False, False, False)]] == [1.0, 0.67, 0.33, 0.0]
    assert one(spark, measures.flag_count(F.col("a"), F.col("b"), F.col("c")), schema, (True, False, True)) == 2


def test_longevity_activity_friendliness(spark):
    got = [one(spark, labels.longevity_category(F.col("v")), "v double", (v,)) for v in (14.0, 12.0, 10.0, 9.9, None)]
    assert got == ["Long-lived", "Average lifespan", "Moderate lifespan", "Short-lived", "Short-lived"]
    got = [one(spark, labels.activity_level(F.col("g")), "g string", (g,))
           for g in ("Herding", "Terrier", "Hound", "Non-Sporting", "Mixed", "", None)]
    assert got == ["High", "Medium-High", "Medium", "Low-Medium", "Unknown", "Unknown", "Unknown"]
    got = [one(spark, labels.family_friendliness(F.col("t")), "t string", (t,))
           for t in ("Unfriendly", "Alert, Dominant", "Alert, Patient", "Stubborn", None)]
    assert got == ["Family-Friendly", "Protective/Guardian", "Family-Friendly", "Moderate", "Unknown"]


def test_list_length_counts_blanks(spark):
    f = measures.list_length(F.col("t"))
    assert [one(spark, f, "t string", (t,)) for t in ("Friendly, , Calm", "Gentle", None)] == [3, 1, 0]
