"""Queries against their SQL."""

import duckdb
import pytest

from cardlake.llm.oracles import ORACLES
from cardlake.llm.queries import QUERIES
from tests.compare import duck_rows, spark_rows

TABLES = ["documents", "pages", "benchmark", "labels", "conversations"]
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
         "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    frame = QUERIES[name](spark, sf_dir)
    columns, rows = spark_rows(frame)
    expected_columns, expected = duck_rows(connection, ORACLES[name])
    assert columns == expected_columns
    assert rows and rows == expected
    described = connection.execute(f"describe {ORACLES[name]}").fetchall()
    assert {c: TYPES[t] for c, t in frame.dtypes} == {d[0]: d[1] for d in described}
