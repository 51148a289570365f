import os

import pytest
from oracle import compare

from sedimenta.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, name):
    compare(spark, name, registry.queries()[name], registry.oracle_sql()[name], SF)
