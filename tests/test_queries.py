"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_queries import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(set(queries()) - {n for n in queries() if n == "pipeline" or n.startswith("op")}))
def test_query(spark, name):
    df = queries()[name](spark, SF)
    if name in oracle_sql():
        con = connect(SF)
        assert compare(df, con, oracle_sql()[name]).startswith("ok")
    else:
        assert df.count() > 0


#: Queries of the training-data subpackage: tests/llm holds them against brute force.
WITHOUT_SQL = {name for name in queries() if name == "pipeline" or name.startswith("op")} - set(oracle_sql())


def test_every_check_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(queries()) - set(oracle_sql()) == WITHOUT_SQL


def test_entry(spark):
    assert entry(spark).count() == 42
