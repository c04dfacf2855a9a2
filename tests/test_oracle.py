import pytest

from spanloom.plans import load, registry

from .compare import same

load()
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_same_rows_as_sql(spark, name):
    same(spark, SF, registry.QUERIES[name], registry.ORACLE[name])


def test_every_query_without_sql_gives_rows(spark):
    for name in set(registry.QUERIES) - set(registry.ORACLE):
        assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
