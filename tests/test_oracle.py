"""Every core query against its SQL on the small tables."""

import pytest
from compare import spark_rows, sql_rows

from weftline.plans import io_queries, reference_queries, skew_queries

DATA = "/root/testdata/sf0.001"
CASES = {name: (f, part.SQL.get(name)) for part in (reference_queries, io_queries, skew_queries) for name, f in part.QUERIES.items()}


@pytest.mark.parametrize("name", sorted(CASES))
def test_query(spark, name):
    query, sql = CASES[name]
    rows = spark_rows(query(spark, DATA))
    if sql is None:
        assert rows
    else:
        assert rows == sql_rows(DATA, sql)


def test_entry_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"p2_found", "cf_item_topn"} <= set(entry.queries())
