"""A key holding a third of the rows: the shuffle join splits it, aggregation combines map-side."""

import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")

RUNTIME_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",                 # as for a 20 B-row part table
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in RUNTIME_CONF}
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_part_key_is_split(spark, skew_conf):
    # several map tasks, as many input splits would give on a cluster (AQE splits a
    # hot reducer partition along map-output blocks)
    li = spark.read.parquet(f"{SF}/lineitem.parquet").repartition(8)
    hot = li.select(F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_partkey")).alias("l_partkey"),
                    "l_quantity", "l_orderkey", "l_extendedprice", "l_shipdate")
    part = spark.read.parquet(f"{SF}/part.parquet").select("p_partkey", "p_type")
    out = (hot.join(part, hot["l_partkey"] == part["p_partkey"])
           .groupBy("p_type").agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("q"),
                                  F.max("l_shipdate").alias("last"), F.max("l_orderkey").alias("o"),
                                  F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("p")))
    got = {r["p_type"]: r["q"] for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "isSkewJoin=true" in plan or "skew=true" in plan
    # same answer as a join-free lookup of each row's type
    types = {r["p_partkey"]: r["p_type"] for r in part.collect()}
    want = {}
    for r in hot.collect():
        t = types.get(r["l_partkey"])
        if t is not None:
            want[t] = want.get(t, 0) + r["l_quantity"]
    assert {k: float(v) for k, v in got.items()} == pytest.approx(want)
