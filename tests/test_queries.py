"""Every query against its SQL on the smallest tables, and what SQL cannot say against plain Python."""

import pytest
from oracle import rows_of, rows_of_sql

from cutlight import registry

SF = "/root/testdata/sf0.001"
STREAMS = {n for n in registry.QUERIES if "stream" in n}


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql_gives_the_same_rows(spark, name):
    got, want = rows_of(registry.QUERIES[name](spark, SF)), rows_of_sql(SF, registry.SQL[name])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_the_rest_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
