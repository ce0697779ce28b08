"""Every query with a SQL oracle equals DuckDB on the same tables (sf0.001).
Set SESSIONLAB_ORACLE_SF to run another scale."""
import os

import pytest

from sessionlab.plans import catalog
from compare import compare, duck
from conftest import SF001

SF = os.environ.get("SESSIONLAB_ORACLE_SF", SF001)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(catalog.QUERIES[name](spark, SF), con, catalog.ORACLE[name])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["match"], r


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)
