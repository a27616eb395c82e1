"""Every registered key against its DuckDB oracle (row count, columns and an
order-insensitive value hash), at sf0.001."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from martwright import registry
from oracle_compare import duck, table_hash

KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_oracle():
    assert set(KEYS) <= set(entry.queries()) and set(KEYS) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_date", "order_count", "total_revenue", "average_order_value"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(entry.oracle_sql()[key])
    d_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(s_rows) == len(d_rows)
    assert table_hash(df.columns, s_rows)[0] == table_hash(rel.columns, d_rows)[0]
