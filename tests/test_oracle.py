"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from tessera.plans import registry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert name in ORACLES, "every query of the engine has an oracle"
    compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
