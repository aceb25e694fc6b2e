"""Every registered query against its DuckDB SQL twin (rows, column names, values) on the small scale."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF_SMALL
from sheetwright.plans.oracles import ORACLES
from sheetwright.plans.registry import QUERIES

from scripts.oracle_check import TABLES, digest  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) > 0
    if name not in ORACLES:
        return
    rel = duck.sql(ORACLES[name])
    o_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(o_rows)
    assert digest(df.columns, rows) == digest(list(rel.columns), o_rows)


_DUCK_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
              "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]", "date": "DATE"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_types_match_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(ORACLES[name])
    spark_types = {f.name: _DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:7] == ["viewObjectModelTop", "viewObjectModel", "viewObjectModelService", "viewObjectName",
                              "databaseTable", "colCnt", "colCntPK"]
