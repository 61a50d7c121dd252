"""Every registered plan against its DuckDB oracle on the smallest tables."""

import pytest

from tessera.plans import ORACLES, QUERIES
from tessera.plans.check import compare

from .conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck_small, name):
    ok, rows, _, detail = compare(spark, SF_SMALL, name, QUERIES[name], ORACLES[name], duck_small)
    assert ok, detail


def test_queries_without_sql():
    """Tested against brute force: clu_hdbscan in test_density_tree."""
    assert set(QUERIES) - set(ORACLES) == {"clu_hdbscan"}


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
