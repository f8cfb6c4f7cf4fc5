"""Every query that has SQL equals it; the others give rows with a stable schema."""

from __future__ import annotations

import pytest

from quire.queries import ORACLE_SQL, QUERIES

from .conftest import canonical


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, data, duck, name):
    got = QUERIES[name](spark, data)
    rows = [tuple(r) for r in got.collect()]
    cursor = duck.execute(ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    assert want, "an empty result compares nothing"
    assert canonical(got.columns, rows) == canonical(names, want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_gives_rows(spark, data, name):
    got = QUERIES[name](spark, data)
    assert got.count() > 0
