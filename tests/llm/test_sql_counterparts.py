"""Queries that SQL can express, against DuckDB on the given tables."""

import compare
import pytest

from chatterscope.llm.queries import ORACLE, REGISTRY


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "REGISTRY", REGISTRY)
    monkeypatch.setattr(compare, "ORACLE", ORACLE)
    assert compare.differences(spark, name, "sf0.001") == []


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))
