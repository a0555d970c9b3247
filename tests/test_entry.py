"""Driver contract at sf0.001: the flagship runs and a sample of queries
matches its DuckDB oracle (``check_oracle.py`` runs all of them)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import digest
from spendgrid.sources.tables import TEST_TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables missing")


def test_entry_schema(spark):
    df = E.entry(spark)
    assert len(df.columns) == 54
    assert df.count() > 0


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["sales_details", "monthly_summary", "snapshot",
                                  "ratio_attributes", "store_attributes", "basket",
                                  "point_in_time", "stratified_split", "roc_auc",
                                  "rfm_summary"])
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]
