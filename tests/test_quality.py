"""Data-quality rules: failing rows, one-pass summary, severity, stored failures."""

import datetime as dt
from collections import Counter

import pytest

from traitlens.operators import quality as Q
from traitlens.plans.quality_rules import star_rules
from traitlens.plans.star import build_star


def test_rule_count_matches_model():
    assert len(star_rules()) == 58  # plus one source recency rule = 59


def test_row_rules_null_passes(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", 5.0), (3, "Toy", 0.5)], "k long, g string, v double")
    vals = Q.accepted_values("t", "g", ["Toy"])
    rng = Q.accepted_range("t", "v", 0, 1)
    nn = Q.not_null("t", "g")
    assert [r.row_key for r in Q.failing_rows(df, vals, "k").collect()] == [2]
    assert [r.row_key for r in Q.failing_rows(df, rng, "k").collect()] == [2]
    assert [r.row_key for r in Q.failing_rows(df, nn, "k").collect()] == [1]
    expr = Q.expression_is_true("t", "small", "v < 1")
    assert [r.row_key for r in Q.failing_rows(df, expr, "k").collect()] == [2]   # NULL -> pass


def test_failing_rows_all_equals_union_of_single_rules(spark, inputs):
    tables = build_star(inputs.raw)
    rules = [r for r in star_rules() if r.table == "stg_profiles" and r.kind in Q.ROW_KINDS]
    one_pass = Q.failing_rows_all(tables["stg_profiles"], rules, "breed_id")
    union = None
    for r in rules:
        part = Q.failing_rows(tables["stg_profiles"], r, "breed_id")
        union = part if union is None else union.unionByName(part)
    assert one_pass.exceptAll(union).count() == 0 and union.exceptAll(one_pass).count() == 0


def test_planted_rows_fail_range_and_order_rules(inputs):
    summary = {r.test_name: r.failures for r in Q.summarize(build_star(inputs.raw), star_rules()).collect()}
    raw = inputs.raw
    heights = raw.where("height__imperial = '45 - 42.5'").count()
    lives = raw.where("life_span = '29 - 27 years'").count()
    assert summary["accepted_range__stg_profiles__height_min_inches"] == heights
    assert summary["expression_is_true__stg_profiles__height_order"] == heights
    assert summary["accepted_range__stg_profiles__life_span_min_years"] == lives
    assert summary["expression_is_true__fct_metrics__life_span_order"] == lives
    assert summary["unique__stg_profiles__breed_id"] == 0
    assert summary["relationships__fct_metrics__breed_id"] == 0


def test_unique_and_relationships(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "k long")
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    dup = Q.duplicate_keys(child, Q.unique("c", "k")).collect()
    assert [(r.value, r.n_rows) for r in dup] == [("1", 2)]
    orphans = Q.orphan_keys(child, parent, Q.relationships("c", "k", "p", "k")).collect()
    assert [(r.child_key, r.n_rows) for r in orphans] == [(9, 1)]


def test_summary_evaluates_relationships_within_one_frame(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 9)], "k long, parent long")
    rules = [Q.relationships("c", "parent", "c", "k"), Q.relationships("c", "k", "c", "k")]
    out = Q.summarize({"c": df}, rules)
    assert {r.test_name: r.failures for r in out.collect()} == {
        "relationships__c__parent": 1, "relationships__c__k": 0}
    assert "Range" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_enforce_raises_on_error_severity(inputs):
    summary = Q.summarize(build_star(inputs.raw), star_rules())
    with pytest.raises(Q.QualityError):
        Q.enforce(summary)
    warn_only = [Q.Rule(r.table, r.kind, r.column, r.values, r.low, r.high, r.expression, r.parent,
                        r.parent_column, "warn") for r in star_rules()]
    Q.enforce(Q.summarize(build_star(inputs.raw), warn_only))


def test_recency(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 8, 26, 14, 0),)], "ts timestamp")
    ok = Q.recency(df, "ts", dt.datetime(2025, 8, 30), 7, "r").first()
    late = Q.recency(df, "ts", dt.datetime(2025, 9, 30), 7, "r").first()
    assert ok.passed is True and late.passed is False


def test_star_consistency_tags_missing_and_orphans(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "breed_id long, breed_name string")
    fct = spark.createDataFrame([(1, "a"), (3, "c")], "breed_id long, breed_name string")
    out = {(r.issue_type, r.breed_id, r.issue_description)
           for r in Q.star_consistency(dim, {"fct": fct}, "breed_id", "breed_name").collect()}
    assert out == {("fct", 2, "missing_breed"), ("fct", 3, "orphaned_record")}


def test_store_failures_writes_tests_schema(spark, inputs):
    rules = [r for r in star_rules() if r.kind == "accepted_range" and r.table == "stg_profiles"]
    failing = Q.failing_rows_all(inputs.stg, rules, "breed_id")
    name = Q.store_failures(failing, "prof", "range_failures")
    assert name == "`prof_tests`.`range_failures`"
    assert spark.table("prof_tests.range_failures").count() == failing.count() > 0


def test_summary_is_single_scan_per_table(inputs):
    rules = [r for r in star_rules() if r.table == "dim_profiles" and r.kind in Q.ROW_KINDS]
    plan = Q.summarize(build_star(inputs.raw), rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_duplicate_keys_all_equals_single_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (3, None)], "k long, n string")
    rules = [Q.unique("t", "k"), Q.unique("t", "n")]
    one = Q.duplicate_keys_all(df, rules)
    single = Q.duplicate_keys(df, rules[0]).unionByName(Q.duplicate_keys(df, rules[1]))
    assert one.exceptAll(single).count() == 0 and single.exceptAll(one).count() == 0


def test_relationship_on_one_shared_frame_has_no_orphans(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "breed_id long")
    rule = Q.relationships("child", "breed_id", "parent", "breed_id")
    shared = Q.summarize({"child": df, "parent": df}, [rule]).first()
    separate = Q.summarize({"child": df, "parent": spark.createDataFrame([(1,)], "breed_id long")}, [rule]).first()
    assert shared.failures == 0 and shared.status == "pass"
    assert separate.failures == 1 and separate.status == "fail"


def test_recency_units(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 8, 26, 14, 0),)], "ts timestamp")
    assert Q.recency(df, "ts", dt.datetime(2025, 8, 26, 15, 30), 2, "r", unit="hour").first().passed is True
    assert Q.recency(df, "ts", dt.datetime(2025, 8, 26, 17, 0), 2, "r", unit="hour").first().passed is False
    assert Q.recency(df, "ts", dt.datetime(2025, 8, 26, 14, 20), 30, "r", unit="minute").first().passed is True


def test_star_consistency_reads_each_table_once_and_keeps_every_record(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "n"), (4, None)], "k long, v string")
    fct = spark.createDataFrame([(1,), (7,), (7,), (None,)], "k long")
    traits = spark.createDataFrame([(1, "x"), (2, "y"), (8, "z")] + [(9, "h")] * 2500, "k int, v string")
    got = Counter(tuple(r) for r in Q.star_consistency(dim, {"fct": fct, "traits": traits}, "k", "v").collect())
    want = Counter({("fct", 2, "b", "missing_breed"): 2, ("fct", None, "n", "missing_breed"): 1,
                    ("fct", 4, None, "missing_breed"): 1, ("traits", None, "n", "missing_breed"): 1,
                    ("traits", 4, None, "missing_breed"): 1, ("fct", 7, None, "orphaned_record"): 2,
                    ("fct", None, None, "orphaned_record"): 1, ("traits", 8, "z", "orphaned_record"): 1,
                    ("traits", 9, "h", "orphaned_record"): 2500})
    assert got == want
    empty = dim.where("false")
    assert Q.star_consistency(empty, {"fct": empty}, "k", "v").count() == 0
    plan = Q.star_consistency(dim, {"fct": fct, "traits": traits}, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Scan ExistingRDD") == 3
