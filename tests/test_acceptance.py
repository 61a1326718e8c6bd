"""Every registered query against its SQL, on the smallest driver tables."""

import os
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from acceptance.compare import differences, oracle_connection
from acceptance.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def windows_in_one_task(physical: str) -> bool:
    """True if the shuffle below some window gathers the whole relation."""
    lines = physical.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line):
            below = next((x for x in lines[i + 1 :] if "Exchange" in x), "")
            if "SinglePartition" in below:
                return True
    return False


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, oracle, plan_of, name):
    df = QUERIES[name](spark, SF)
    assert differences(oracle, name, df)[1] == []
    physical = plan_of(df, "simple")
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical
    assert not windows_in_one_task(physical)


def test_a_window_in_one_task_is_noticed(spark, plan_of):
    df = spark.range(10).withColumn("g", F.col("id") % 2)
    bad = df.withColumn("m", F.max("id").over(Window.partitionBy()))
    good = df.withColumn("m", F.max("id").over(Window.partitionBy("g")))
    assert windows_in_one_task(plan_of(bad, "simple")) and not windows_in_one_task(plan_of(good, "simple"))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
