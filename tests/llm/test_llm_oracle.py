"""Registered operator queries against their SQL on the smallest tables."""

import check
import pytest

from waymeter.llm.oracle import ORACLE
from waymeter.llm.queries import QUERIES

SF = f"{check.TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert check.differences(spark, con, name, QUERIES[name], ORACLE[name], SF) is None
