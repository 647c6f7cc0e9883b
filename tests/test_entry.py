"""Driver contract: entry(), queries() and oracle_sql() agree with DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from rill.sources.tables import TABLES
from tools.check_oracle import compare

def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 20
    assert df.columns == ["bigram", "avg_match_count"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql())))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert compare(got, want) == "ok"


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_non_sql_queries_run(spark, name):
    assert entry.queries()[name](spark, SF_SMALL).count() > 0
