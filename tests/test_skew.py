"""Hot keys: one unit holding about half of all logs must be split, pre-aggregated, and still give exact results."""

import os

import pytest
from pyspark.sql import functions as F

from upkeep.operators import due
from upkeep.plans import views
from upkeep.sources import testdata as td

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed(spark):
    t = td.load(spark, SF)
    logs = t.maintenance_log
    hot = logs.withColumn("equipment_id", F.lit(0).cast("bigint")).withColumn("id", F.col("id") + F.lit(10**9))
    return t, t.with_(maintenance_log=logs.unionByName(hot))


def test_hot_unit_join_is_split_and_exact(spark, skew_conf):
    t, skewed = _skewed(spark)
    df = views.maintenance_timeline(skewed, ordered=False)
    got = sorted(map(repr, df.collect()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    for k in SKEW_CONF:
        spark.conf.unset(k)
    want = sorted(map(repr, views.maintenance_timeline(skewed, ordered=False).collect()))
    assert got == want


def test_hot_unit_is_collapsed_before_the_shuffle(spark):
    _, skewed = _skewed(spark)
    plan = due.last_log(skewed.maintenance_log)._jdf.queryExecution().executedPlan().toString()
    # partial max runs map-side, so the hot unit sends one row per (task, map task) to the reducers
    assert "partial_max" in plan
    rows = {(r.equipment_id, r.task_id) for r in due.last_log(skewed.maintenance_log).collect()}
    assert len([k for k in rows if k[0] == 0]) <= 5
