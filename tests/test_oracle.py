"""Every registered query against its DuckDB oracle on the sf0.001 tables.

Values are compared exactly: the fixture book keeps every summed value a binary
fraction, so sums agree bit for bit whatever the order.
"""

import pytest

from conftest import SF0001
from ratecell import oracle, registry
from ratecell.verify import compare

SQL = oracle.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF0001)
    r = compare(df, duck, SQL[name])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["match"], r


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(registry.QUERIES) <= set(e.queries())
    assert set(SQL) <= set(e.oracle_sql()) <= set(e.queries())
