"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from harness import compare, connect

from textmill.registered import QUERIES, SQL, load_all

load_all()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf, duck, name):
    result = compare(name, spark, sf, duck)
    assert result["status"] in ("ok", "ok (empty)", "rows-only"), result
    if name not in SQL:
        assert result["rows"] > 0
