"""Every registered query at the smallest size: schema, and agreement with its SQL."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns[-2:] == ["effective_confidence", "band"]
    assert rows.count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, engine, name, capsys):
    df = queries()[name](spark, SF)
    capsys.readouterr()
    df.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    got = df.toPandas()
    assert list(got.columns)
    if name in oracle_sql():
        assert rows_of(got) == rows_of(engine.sql(oracle_sql()[name]).df())
