import pytest

from spindrift.llm import queries

from ..oracle import connection, same


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    pytest.importorskip("duckdb")
    same(spark, connection(), queries.queries()[name], queries.oracle_sql()[name])


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.queries()) == list(range(1, 11))
