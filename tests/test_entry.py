"""Every registered query against its SQL counterpart, on the smallest sample."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from compare import TABLES, rows_of

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="sample tables are not here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


#: Queries that SQL can't express, with the tests that compare their whole results otherwise.
TESTED_ELSEWHERE = {
    "op3_toxicity": "tests/llm/test_plain_versions.py",
    "op6_pack_tokens": "tests/llm/test_plain_versions.py",
    "op7_decontaminate": "tests/llm/test_plain_versions.py",
    "op9_language_id": "tests/llm/test_plain_versions.py",
    "op10_suffix_sort_dedup": "tests/llm/test_pairs.py",
    "pipeline": "tests/llm/test_corpus_pipeline.py",
}


def test_queries_have_sql_or_a_test_of_their_own():
    without = set(registry.queries()) - set(registry.oracle_sql())
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert without <= set(TESTED_ELSEWHERE)
    assert all((Path(__file__).parent.parent / TESTED_ELSEWHERE[name]).exists() for name in without)


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = registry.queries()[name](spark, str(SF_DIR))
    result = con.execute(registry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


def test_expected_counts(spark):
    counts = {"bars": 397, "ohlc_inconsistency": 15, "duplicate_rows": 5, "stale_price": 4,
              "outlier_return": 33, "missing_dates": 38}
    queries = registry.queries()
    assert {n: queries[n](spark, str(SF_DIR)).count() for n in counts} == counts


def test_flagship(spark):
    assert registry.entry(spark).count() > 0
