"""Every registered query runs over the small driver tables and equals its oracle SQL."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from traitlens.plans import registry as R
from traitlens.sources.tables import TABLES, table_path

from conftest import SF_SMALL


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{table_path(SF_SMALL, t)}')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["size_category", "breed_count"]


def test_every_query_has_an_oracle():
    missing = set(R.queries()) - set(R.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(R.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _bag(df.columns, srows) == _bag(ocols, orows)


_TYPES = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
          "BooleanType": "BOOLEAN", "TimestampType": "TIMESTAMP", "TimestampNTZType": "TIMESTAMP",
          "DateType": "DATE", "ArrayType": "VARCHAR[]"}


@pytest.mark.parametrize("name", sorted(R.queries()))
def test_query_types_match_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    spark_types = {f.name: _TYPES.get(type(f.dataType).__name__, type(f.dataType).__name__)
                   for f in df.schema.fields}
    res = duck.execute(f"select * from ({E.oracle_sql()[name]}) limit 0")
    oracle_types = {d[0]: str(d[1]) for d in res.description}
    assert spark_types == oracle_types
