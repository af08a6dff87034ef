"""Every query with SQL gives the rows that DuckDB gives."""

import pytest

from ledgerline.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_gives_the_rows_of_its_sql(name, same, spark, sf):
    if name in catalog.ORACLE_SQL:
        same(catalog.QUERIES[name], catalog.ORACLE_SQL[name])
    else:
        assert catalog.QUERIES[name](spark, sf).count() >= 0


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
