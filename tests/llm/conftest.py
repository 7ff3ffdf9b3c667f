from __future__ import annotations

import os

import duckdb
import pytest

from tests.conftest import TESTDATA


@pytest.fixture(scope="session")
def sf_dir():
    """The smallest tables hold no secrets, so these tests take the next size."""
    return str(TESTDATA / os.environ.get("CARDLAKE_LLM_SF", "sf0.01"))


@pytest.fixture(scope="session")
def table(sf_dir):
    """Rows of a test table, as tuples of the named columns."""
    connection = duckdb.connect()

    def rows(name: str, columns: str):
        return connection.execute(
            f"select {columns} from '{sf_dir}/{name}.parquet'"
        ).fetchall()

    yield rows
    connection.close()
