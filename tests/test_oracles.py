"""Registered queries against their SQL on the smallest tables."""

import pytest

from footform.plans.queries import ORACLE_SQL, QUERIES
from tests.helpers import rows, sql_rows

def test_every_query_has_columns_without_clash():
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    assert rows(QUERIES[name](spark, sf_dir)) == sql_rows(ORACLE_SQL[name], sf_dir)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() >= 0
