import pytest

import __spark_entry__ as entry
from tools.crosscheck import compare, duckdb_tables

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duckdb_tables(SF)


def test_every_check_belongs_to_a_query():
    assert set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    frame = entry.queries()[name](spark, SF)
    if name in ORACLE:
        assert compare(frame, duck.sql(ORACLE[name]).to_arrow_table()) is None
    else:
        assert frame.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
