import os

import pytest
from oracle import compare

from sedimenta.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query(spark, name):
    compare(spark, name, queries.queries()[name], queries.oracle_sql()[name], SF)
