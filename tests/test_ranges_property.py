"""Property: Spark range parsing equals the independently written DuckDB oracle expressions."""

import math

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from traitlens.functions import ranges
from traitlens.plans import oracle as O

number = st.one_of(st.integers(0, 150).map(str),
                   st.tuples(st.integers(0, 99), st.integers(0, 9)).map(lambda t: f"{t[0]}.{t[1]}"))
piece = st.one_of(number, st.sampled_from(["up", "NaN", "years", "year", "abc", ""]))
dash = st.sampled_from([" - ", " – ", "-", "–", " -", "- "])
pad = st.sampled_from(["", " ", "  "])
text = st.one_of(
    st.none(),
    st.builds(lambda a, p, q: p + a + q, piece, pad, pad),
    st.builds(lambda a, d, b, p: p + a + d + b, piece, dash, piece, pad),
    st.builds(lambda a, d, b, y: a + d + b + y, number, dash, number, st.sampled_from([" years", " year", ""])),
)


def _eq(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return a == b


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(text, min_size=20, max_size=60))
def test_parsers_agree_with_oracle_sql(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, x string")
    cols = []
    for nan in ("null", "propagate"):
        for open_low in (False, True):
            lo, hi = ranges.parse_range(F.col("x"), open_low=open_low, nan=nan)
            cols += [lo.alias(f"lo_{nan}_{open_low}"), hi.alias(f"hi_{nan}_{open_low}")]
    ylo, yhi = ranges.parse_years(F.col("x"))
    got = {r.i: r for r in df.select("i", *cols, ylo.alias("ylo"), yhi.alias("yhi")).collect()}

    con = duckdb.connect()
    con.execute("create table t (i int, x varchar)")
    con.executemany("insert into t values (?, ?)", rows)
    exprs = []
    for nan in ("null", "propagate"):
        for open_low in (False, True):
            exprs += [f"{O._range('x', 1, open_low, nan)} as lo_{nan}_{open_low}",
                      f"{O._range('x', 2, open_low, nan)} as hi_{nan}_{open_low}"]
    exprs += [f"{O._years('x', False)} as ylo", f"{O._years('x', True)} as yhi"]
    res = con.execute(f"select i, {', '.join(exprs)} from t")
    names = [d[0] for d in res.description]
    for orow in res.fetchall():
        want = dict(zip(names, orow))
        have = got[want["i"]]
        for k in names[1:]:
            assert _eq(have[k], want[k]), (values[want["i"]], k, have[k], want[k])
