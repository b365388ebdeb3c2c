"""Every query outside the text subpackage gives what its SQL gives."""

import pytest

from cartolith.plans import registry
from tests.oracle import rows_of_spark, rows_of_sql

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query(spark, name):
    got, want = rows_of_spark(registry.QUERIES[name](spark, FOLDER)), rows_of_sql(registry.SQL[name], FOLDER)
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1], "a comparison of nothing"
