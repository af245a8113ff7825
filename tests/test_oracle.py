"""Every query against its SQL counterpart on the smallest tables."""

import pytest
from compare import differences

from chatterscope.plans.oracle import ORACLE
from chatterscope.plans.queries import REGISTRY


def test_every_query_has_sql():
    assert set(ORACLE) == set(REGISTRY)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, name):
    assert differences(spark, name, "sf0.001") == []
