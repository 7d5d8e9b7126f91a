"""A hot account (a third of all lines and all assets) in the pair join:
AQE splits the skewed partition and the result keeps every pair."""

import contextlib

from pyspark.sql import functions as F

from helpers import assets_df, facts_df
from saletrace.operators.matching import tiered_match


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_account_is_split(spark):
    n_lines, n_assets = 600, 300
    facts = [{"opp_id": f"O{i}", "oli_id": f"L{i}",
              "account_id": "HOT" if i % 3 == 0 else f"A{i % 50}", "family": "F2"}
             for i in range(n_lines)]
    assets = [{"asset_id": f"V{j}", "account_id": "HOT" if j % 3 == 0 else f"A{j % 50}",
               "class_name": "c2"} for j in range(n_assets)]
    lk = spark.createDataFrame([("c2", "F2")], "class_name string, family string")
    with conf(spark, **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}):
        out = tiered_match(facts_df(spark, facts), assets_df(spark, assets), lk)
        got = out.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
        counts = {r["account_id"]: r["n"] for r in got.collect()}
        out.collect()
        # the adaptive plan of this DataFrame, re-planned while it ran
        final = out._jdf.queryExecution().executedPlan().toString()
    hot_lines = len([f for f in facts if f["account_id"] == "HOT"])
    hot_assets = len([a for a in assets if a["account_id"] == "HOT"])
    assert counts["HOT"] == hot_lines * hot_assets
    expected_other = sum(
        len([a for a in assets if a["account_id"] == f["account_id"]]) or 1
        for f in facts if f["account_id"] != "HOT")
    assert sum(v for k, v in counts.items() if k != "HOT") == expected_other
    assert "skew=true" in final
