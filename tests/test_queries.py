"""Every query against its SQL on the smallest tables."""

import pytest

from conftest import SF, same_rows
from sylvan.plans import batches, checks, documents, stages, trees

SQL = trees.SQL | documents.SQL | checks.SQL | batches.SQL | stages.SQL
QUERIES = {f.__name__: f for f in (*trees.QUERIES, *documents.QUERIES, *checks.QUERIES, *batches.QUERIES, *stages.QUERIES)}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    same_rows(QUERIES[name](spark, SF), duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_has_a_row_for_each_nation(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert len(rows) == 1 + 5 + 25 and all(0 <= r["score"] <= 1 for r in rows)
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
