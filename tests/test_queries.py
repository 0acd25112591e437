"""Every query of the library against its SQL."""

import pytest

from tallyframe import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(name, same_rows):
    same_rows(queries.QUERIES[name], queries.ORACLES[name])


def test_entry_names_all_queries(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(queries.QUERIES) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1
