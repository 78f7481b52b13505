"""Range parsing against hand-derived edge rows (FIXTURES F2)."""

import math

import pytest
from pyspark.sql import functions as F

from traitlens.functions import labels, ranges


def parse(spark, values, **kw):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, raw string")
    lo, hi = ranges.parse_range(F.col("raw"), **kw)
    out = df.select("i", lo.alias("lo"), hi.alias("hi"),
                    ranges.range_parse_error(F.col("raw"), lo, hi).alias("err")).orderBy("i")
    return [(r.lo, r.hi, r.err) for r in out.collect()]


def test_weight_imperial_edge_rows(spark):
    values = [None, "  ", "NaN", "up - 13", "up – 13", "6 - 13", "6 – 13", "20 - 25", "40 - 60",
              "80 - 90", "90 - 120", "44", "35-70"]
    got = parse(spark, values, open_low=True)
    assert got == [
        (None, None, False), (None, None, False), (None, None, False),
        (0.0, 13.0, False), (0.0, 13.0, False), (6.0, 13.0, False), (6.0, 13.0, False),
        (20.0, 25.0, False), (40.0, 60.0, False), (80.0, 90.0, False), (90.0, 120.0, False),
        (44.0, 44.0, False), (None, None, True),
    ]


def test_size_category_edge_rows(spark):
    values = [None, "  ", "NaN", "up - 13", "up – 13", "6 - 13", "20 - 25", "40 - 60", "80 - 90",
              "90 - 120", "44", "35-70"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, raw string")
    _, hi = ranges.parse_range(F.col("raw"), open_low=True)
    got = [r.s for r in df.select("i", labels.size_category(F.col("raw"), hi).alias("s")).orderBy("i").collect()]
    assert got == [None, None, None, "Very Small", "Very Small", "Small", "Small", "Medium", "Large",
                   "Extra Large", "Medium", None]


def test_presence_flag_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(None,), ("",), ("NaN",), ("5",)], "raw string")
    got = [r.p for r in df.select(ranges.is_present(F.col("raw")).alias("p")).collect()]
    assert got == [False, False, False, True]


def test_weight_metric_nan_forms(spark):
    assert parse(spark, ["NaN", "NaN - 8", "3 - 6"]) == [(None, None, False), (None, 8.0, False),
                                                        (3.0, 6.0, False)]
    lit = parse(spark, ["NaN", "NaN - 8"], nan="propagate")
    assert lit[0][:2] == (None, None)
    assert math.isnan(lit[1][0]) and lit[1][1] == 8.0


def test_height_edge_rows(spark):
    assert parse(spark, ["9 - 11.5", "27", "0", "45 - 42.5"]) == [
        (9.0, 11.5, False), (27.0, 27.0, False), (0.0, 0.0, False), (45.0, 42.5, False)]


def test_life_span_edge_rows(spark):
    values = ["10 - 12 years", "8 – 15 years", "12 years", "10 - 12", "10 years - 12 years", "unknown",
              None, " "]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, raw string")
    lo, hi = ranges.parse_years(F.col("raw"))
    got = [(r.lo, r.hi) for r in df.select("i", lo.alias("lo"), hi.alias("hi")).orderBy("i").collect()]
    assert got == [(10, 12), (8, 15), (12, 12), (10, None), (10, 10), (None, None), (None, None), (None, None)]
    present = [r.p for r in df.select("i", ranges.is_present(F.col("raw"), sentinel=False).alias("p"))
               .orderBy("i").collect()]
    assert present[5] is True  # 'unknown' counts as present: parse_error tells it apart


def test_strict_mode_raises_on_bad_text(spark):
    df = spark.createDataFrame([("35-70",)], "raw string")
    lo, _ = ranges.parse_range(F.col("raw"), strict=True)
    with pytest.raises(Exception):
        df.select(lo).collect()


def test_bounds_are_one_small_expression(spark):
    # Filters on derived labels get pushed below staging and inline these
    # expressions: keep them free of CASE branches.
    lo, hi = ranges.parse_range(F.col("raw"), open_low=True)
    for bound in (lo, hi):
        assert "CASE" not in str(bound).upper()
