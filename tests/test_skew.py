"""Joins whose key is very common: adaptive execution has to split the hot partition, and nothing may get lost."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators import marts, quality, windows
from starmart.sources.staging import stage

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "400000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200000",
    "spark.sql.shuffle.partitions": "32",
}


@pytest.fixture(autouse=True)
def small_thresholds(spark):
    old = {name: spark.conf.get(name, None) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def facts(spark):
    """120,000 rows; one driver and one score hold a third of them."""
    hot = F.col("id") % 3 == 0
    rows = spark.range(0, 120_000, 1, 8).select(
        "id",
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 5000).alias("driver_id"),
        F.when(hot, F.lit(1)).otherwise(F.col("id") % 7000).alias("points"),
        (F.lit(2020) + F.col("id") % 2).alias("year"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    return stage(rows, "skewed")


def final_plan(df):
    """Run the whole of ``df`` and return the plan that was used in the end."""
    check = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*df.columns)).alias("h"))
    rows = check.collect()[0].n
    return rows, check._jdf.queryExecution().executedPlan().toString()


def test_star_join_splits_a_hot_driver(spark, facts):
    drivers = spark.range(4000).select(F.col("id").alias("driver_id"), F.md5(F.col("id").cast("string")).alias("driver_name"))
    rows, plan = final_plan(marts.star_join(facts, [(drivers, {"driver_id": "driver_id"}, ["driver_name"])]))
    assert rows == 120_000 and "skew=true" in plan


def test_ranking_splits_a_hot_score(spark, facts):
    ranked = windows.rank_within(facts, ["year"], "points", "rk")
    rows, plan = final_plan(ranked)
    assert rows == 120_000 and "skew=true" in plan
    best = Window.partitionBy("year").orderBy(F.col("points").desc_nulls_last())
    plain = facts.select("id", F.rank().over(best).alias("rk2"))
    assert ranked.join(plain, "id").filter("rk = rk2").count() == 120_000


def test_orphans_split_a_hot_reference(spark, facts):
    drivers = spark.range(1, 4000).select(F.col("id").alias("d"))
    lost = quality.orphans(facts, drivers, {"driver_id": "d"})
    rows, plan = final_plan(lost)
    want = facts.filter("driver_id = 0 or driver_id >= 4000").count()
    assert rows == want and "skew=true" in plan
    assert quality.orphan_count(facts, drivers, {"driver_id": "d"}).collect()[0][0] == want
