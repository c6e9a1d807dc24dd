"""Every registered query of the postings engine against its SQL, or at least run."""

import pytest

from postmill.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(compare, name):
    compare(name)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_runs(spark, small, name):
    assert catalog.QUERIES[name](spark, small).count() >= 0


def test_entry_and_imports(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
