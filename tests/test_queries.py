"""Every query beside its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__
import verify
from matchloom.queries import QUERIES, SQL  # filled by __spark_entry__

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in verify.TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    got, want = QUERIES[name](spark, SF).toArrow(), con.sql(SQL[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert verify.normal(got) == verify.normal(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 3
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
