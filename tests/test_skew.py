"""Hot keys: a third of all rows on one member, with nothing small enough to broadcast."""

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import dims, fact
from sparkmart.operators.upsert import upsert
from sparkmart.schema import DIM_BRANCH, DIMS
from sparkmart.sources.staging import stage

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def no_broadcast(spark):
    saved = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_sales(spark, value=7):
    hot = F.lit(value).cast("bigint")
    number = F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id") % 5000)
    return spark.range(0, 300_000, 1, 8).select(
        F.concat(F.lit("B"), number.cast("string")).alias("Branch_ID"),
        F.md5(F.col("id").cast("string")).alias("Branch_Name"),
        F.lit("DT00001").alias("Date_ID"),
        F.col("id").alias("Revenue"),
        F.lit(1).cast("bigint").alias("Units_Sold"),
    )


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("value", [7, None], ids=["member", "missing key"])
def test_hot_value_is_split_in_the_key_lookup(spark, no_broadcast, value):
    sales = hot_sales(spark, value)
    names = sales.select("Branch_ID").dropna().distinct()
    dim = stage(names.select("Branch_ID", F.xxhash64("Branch_ID").alias(DIM_BRANCH.sk)))
    facts = fact.build_fact(sales, {"dim_branch": dim}, [d for d in DIMS if d is DIM_BRANCH], keep=["Branch_Name"])
    rows, plan = executed(facts)
    assert len(rows) == 300_000
    assert sum(r[DIM_BRANCH.sk] is None for r in rows) == (0 if value else 100_000)
    assert "skew=true" in plan


def test_hot_target_key_is_split_in_an_upsert(spark, no_broadcast):
    target = hot_sales(spark).select("Branch_ID", "Branch_Name", "Revenue")
    source = stage(target.select("Branch_ID").distinct().select(
        "Branch_ID", F.lit("new").alias("Branch_Name"), F.lit(0).cast("bigint").alias("Revenue")))
    rows, plan = executed(upsert(target, source, ["Branch_ID"]))
    assert len(rows) == 300_000 and {r["Branch_Name"] for r in rows} == {"new"}
    assert "skew=true" in plan


def test_members_of_a_hot_key(spark, no_broadcast):
    found = dims.members(hot_sales(spark).withColumn("Branch_Name", F.lit("n")), DIM_BRANCH)
    assert found.count() == 5000
