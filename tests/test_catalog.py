import pytest

from docmill.plans import catalog
from tests.oracle import SF, compare, connect

pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_equals_sql(spark, con, name):
    compare(spark, con, catalog.queries()[name], catalog.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert set(catalog.queries()) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() == 5
