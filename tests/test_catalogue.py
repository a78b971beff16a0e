from __future__ import annotations

import pytest
from conftest import SF
from oracle import same

from quern.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name in SQL:
        ok, why = same(rows, df.columns, con, SQL[name])
        assert ok, why
    else:
        assert df.columns
