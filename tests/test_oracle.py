"""Every registered query against DuckDB on the smallest tables."""

import oracle_check
import pytest

from newsloom.queries.catalog import QUERIES
from newsloom.queries.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert oracle_check.compare(got, duck.execute(ORACLE[name]).df()) == ""
