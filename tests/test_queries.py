"""Every query of the library against its SQL."""

import pytest
from oracle import check

from gridquill.plans.catalog import ORACLE_SQL, QUERIES


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, small):
    check(QUERIES[name], ORACLE_SQL[name], spark, small)
