"""Every query with SQL against DuckDB, on whole tables of a small scale factor."""

import pytest

from checks.compare import difference, duckdb_connection
from kinweave.llm.catalog import QUERIES
from kinweave.llm.oracle import ORACLE_SQL

from tests.conftest import SF

TYPES = {"VARCHAR": "string", "INTEGER": "int"}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb_connection(SF)
    result = QUERIES[name](spark, SF)
    assert difference(result, con, ORACLE_SQL[name]) is None
    described = con.execute(f"DESCRIBE {ORACLE_SQL[name]}").fetchall()
    assert dict(result.dtypes) == {r[0]: TYPES.get(r[1], r[1].lower()) for r in described}
