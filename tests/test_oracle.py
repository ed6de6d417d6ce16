"""Every registered query against its DuckDB oracle (the driver's check),
at sf0.001 so the suite stays quick; tools/compare_oracle.py runs sf0.01."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from logsift.plans.catalog import QUERIES
from logsift.plans.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float) and v == int(v):
        return int(v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = _rows(QUERIES[name](spark, SF).toPandas())
    exp = _rows(duck.execute(ORACLE_SQL[name]).df())
    assert got[0] == exp[0]
    assert len(got[1]) == len(exp[1])
    assert got[1] == exp[1]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "document_id", "open_count"]
    assert df.count() == 58


@pytest.mark.parametrize("name", ["parsed_records", "timestamps_dates", "quick_search_opens", "session_summary", "profile_records"])
def test_query_matches_oracle_with_ansi_off(spark, duck, name):
    """A driver session may run without ANSI mode; results must not change."""
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        got = _rows(QUERIES[name](spark, SF).toPandas())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert got == _rows(duck.execute(ORACLE_SQL[name]).df())
