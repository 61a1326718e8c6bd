"""The registered queries on the driver's smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from acceptance.compare import differences, oracle_connection
from acceptance.registry import ORACLES as OTHERS
from hearthlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name, monkeypatch):
    monkeypatch.setitem(OTHERS, name, ORACLES[name])
    assert differences(oracle_connection(SF), name, QUERIES[name](spark, SF))[1] == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"pipeline"}))
def test_query_returns_a_row_per_row(spark, name):
    df = QUERIES[name](spark, SF)
    table, times = {"op6_neighbours": (None, 0), "op13_whitening": ("embeddings", 16)}.get(name, ("documents", 1))
    if table:
        assert df.count() == times * spark.read.parquet(f"{SF}/{table}.parquet").count()
