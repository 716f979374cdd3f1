"""Physical plans: no cross joins, one shuffle for the pivot, filters at the scan."""

import re

import pytest
from pyspark.sql import functions as F

from rollbook.operators import pivot_facts, signed_extreme
from rollbook.registered import QUERIES
from rollbook.registered.adapters import facts

# read-back queries run jobs of their own before they return; their plans are plain scans
SKIP = ("st", "sc0", "sc10", "sc11", "sc12", "sc15", "jb01", "jb02", "jb10", "jb11", "jb12", "mg12")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not n.startswith(SKIP)])
def test_no_cross_joins_and_no_python(spark, data, name):
    plan = physical(QUERIES[name](spark, data))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert node not in plan


def test_pivot_is_one_exchange(spark, data, tmp_path):
    path = str(tmp_path / "facts")
    facts(spark, data).write.parquet(path)
    plan = physical(pivot_facts(spark.read.parquet(path), ["company_number", "end_date"]))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "PushedFilters: [In(label" in plan
    scan = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert scan == "company_number:string,end_date:string,label:string,value:string,seq:bigint"


def test_numeric_pivot_is_a_hash_aggregate(spark, data):
    numbers = facts(spark, data).withColumn("n", F.col("seq").cast("decimal(38,6)"))
    plan = physical(numbers.groupBy("company_number").agg(signed_extreme(F.col("n")).alias("x")))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_time_range_reaches_the_scan(spark, data):
    plan = physical(QUERIES["pf07_time_range"](spark, data))
    assert "GreaterThan(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


def test_latest_per_key_limits_before_the_shuffle(spark, data):
    plan = physical(QUERIES["wn03_latest_per_key"](spark, data))
    assert "WindowGroupLimit" in plan
