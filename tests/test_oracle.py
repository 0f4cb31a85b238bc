"""Every query against the equivalent SQL, on the whole tables of a small scale factor."""

import pytest

from checks.catalog import QUERIES
from checks.compare import difference
from checks.fixtures import DUCKDB, fixture_sql
from checks.oracle import compose, oracle_sql

ORACLE = oracle_sql()
ROWS_ONLY: set[str] = set()


@pytest.mark.parametrize("name", list(fixture_sql(DUCKDB)))
def test_fixture_is_the_same_in_both_engines(case, duck, name):
    assert difference(getattr(case.fx, name), duck, compose(f"SELECT * FROM {name}")) is None


ENGINE_TYPES = {"VARCHAR": "string", "INTEGER": "int", "TIMESTAMP": "timestamp_ntz"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(case, duck, name):
    result = QUERIES[name](case)
    if name in ROWS_ONLY:
        assert result.count() > 0
        return
    assert difference(result, duck, ORACLE[name]) is None
    described = duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    assert dict(result.dtypes) == {r[0]: ENGINE_TYPES.get(r[1], r[1].lower()) for r in described}


def test_every_query_has_sql_or_is_known_not_to():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)
