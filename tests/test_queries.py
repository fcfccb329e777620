"""Every named query against its SQL, on the smallest tables."""

import pytest

from liftspark.plans import registry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"

registry.load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    verdict, n = compare(spark, con, registry.QUERIES[name], registry.ORACLES.get(name), SF)
    assert not verdict
    assert n > 0 or name in registry.ORACLES


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
