"""Every registered query with a SQL form equals its DuckDB oracle (small scale)."""

import duckdb
import pytest

from airlens.plans.oracle import ORACLE
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, register_views


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    register_views(c, SF_SMALL)
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF_SMALL)
    assert ok, f"{name}: {msg}"
