"""Every query against its SQL, and every query has one."""

import pytest

from fixtures.oracles import ORACLES
from fixtures.queries import QUERIES
from tests.compare import duck_rows, spark_rows

TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
}


def test_same_names():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    columns, rows = spark_rows(frame)
    expected_columns, expected = duck_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert rows, "an empty result checks nothing"
    assert rows == expected
    described = duck.execute(f"describe {ORACLES[name]}").fetchall()
    assert {c: TYPES[t] for c, t in frame.dtypes} == {d[0]: d[1] for d in described}
