"""Every registered query against its DuckDB oracle SQL at sf0.001."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from oracle_check import compare, duck

QUERIES = {name: fn for name, fn in entry_mod.queries().items() if name in entry_mod.QUERIES}
ORACLE = {name: sql for name, sql in entry_mod.oracle_sql().items() if name in entry_mod.QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() == 4199
    assert df.columns == ["_tenant_id", "fecha_proceso", "tipo_entrega", "total_units",
                          "total_revenue", "active_routes", "active_transports"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert res["ok"], res
