"""Every registered query of the library against its SQL on the smallest tables."""

import pytest

from docflow.plans import registry
from tests.compare import connect, same

NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, con, name):
    df = registry.queries()[name](spark, sf)
    sql = registry.oracle_sql().get(name)
    if sql:
        same(df, con, sql)
    else:
        assert df.columns and df.count() >= 0


def test_names_are_unique_and_every_oracle_has_a_query():
    assert set(registry.oracle_sql()) <= set(NAMES) and len(NAMES) > 80


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
