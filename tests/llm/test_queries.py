import pytest

from docmill.llm import queries
from tests.oracle import SF, compare, connect

pytest.importorskip("duckdb")
COLUMNS = {
    "p2_found": ["id", "family"], "p3_found": ["kind", "id"], "p4_found": ["id_a", "id_b"], "p5_found": ["id", "line_no"], "p6_found": ["vec_a", "vec_b"], "p9_found": ["doc_id", "category"],
}


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, con, name):
    compare(spark, con, queries.queries()[name], queries.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_runs_with_distinct_rows(spark, name):
    df = queries.queries()[name](spark, SF)
    assert df.columns == COLUMNS.get(name, df.columns)
    if name in COLUMNS:
        assert df.count() == df.distinct().count()
    else:
        df.write.format("noop").mode("overwrite").save()
