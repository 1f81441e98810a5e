"""The operators that SQL can express equal their DuckDB SQL on the driver's table."""

import duckdb
import pytest

from airlens.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_CHECK


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for name_ in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {name_} AS SELECT * FROM '{SF_CHECK}/{name_}.parquet'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF_CHECK).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
