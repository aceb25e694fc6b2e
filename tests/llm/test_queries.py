import duckdb
import pytest
from odd import SF

from sheetwright.llm.queries import ORACLES, QUERIES

TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twin(spark, name):
    """Rows, column names and types of a query and of its SQL twin."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, rel = QUERIES[name](spark, SF), con.sql(ORACLES[name])
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}
    assert {f.name: kinds[f.dataType.simpleString()] for f in df.schema} == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    got = sorted((tuple(r) for r in df.select(rel.columns).collect()), key=str)
    assert got == sorted(rel.fetchall(), key=str)


def test_every_operator_has_one_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
