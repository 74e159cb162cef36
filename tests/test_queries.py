import pytest

from tests.oracle import duck, spark_rows
from tidemark.plans import registry

SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, data, name):
    got = spark_rows(registry.queries()[name](spark, data))
    if name in SQL:
        assert got == duck(data, SQL[name])
    else:
        assert got[1]


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
