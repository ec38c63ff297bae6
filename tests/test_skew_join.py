"""Salted left joins: same rows as the plain join, and even tasks without AQE."""

import statistics

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ordermart.operators import silver as S
from ordermart.operators import skew_join as J

OFF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


@pytest.fixture
def plain_joins(spark):
    """Shuffle joins only, no help from AQE."""
    before = {k: spark.conf.get(k) for k in OFF}
    for k, v in OFF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def skewed(spark, n=60_000):
    """A third of the rows without a key, a third with one key."""
    i = F.col("id")
    key = F.when(i % 3 == 1, F.lit(7)).when(i % 3 == 2, i % 1009)
    fact = spark.range(n).select(i.alias("order_id"), key.cast("long").alias("k"))
    dim = spark.range(1500).filter("id % 5 <> 3").select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    return fact, dim.unionByName(spark.createDataFrame([(None, "nobody"), (7, "again")], "k long, name string"))


def per_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_even_tasks_without_aqe(plain_joins):
    fact, dim = skewed(plain_joins)
    join = J.left_join(fact, dim, "k", ["order_id"], salt_rows=500)
    assert "SortMergeJoin" in join._jdf.queryExecution().executedPlan().toString()
    sizes, bad = per_task(join), per_task(fact.join(dim, "k", "left"))
    assert max(sizes) < 3 * statistics.median(sizes) and max(sizes) < 2 * sum(sizes) / 8
    assert max(bad) > 3 * statistics.median(bad)  # what the plain join does
    assert rows(join) == rows(fact.join(dim, "k", "left"))
    assert join.columns == fact.join(dim, "k", "left").columns


def test_small_dimension_is_broadcast(spark):
    fact, dim = skewed(spark, 1000)
    plan = J.left_join(fact, dim, "k", ["order_id"], salt_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "xxhash64" not in plan


def test_no_heavy_keys_and_no_rows(plain_joins):
    fact, dim = skewed(plain_joins, 300)
    for f in (fact, fact.limit(0)):
        assert rows(J.left_join(f, dim, "k", ["order_id"])) == rows(f.join(dim, "k", "left"))
        assert rows(J.left_join(f, dim.limit(0), "k", ["order_id"])) == rows(f.join(dim.limit(0), "k", "left"))


def test_heavy_counts_are_bounded(spark):
    fact, _ = skewed(spark, 3000)
    assert J.heavy_counts(fact, "k", 900) == {7: 1001}
    assert list(J.heavy_counts(fact, "k", 0, max_keys=3).items())[0] == (7, 1001)
    assert len(J.heavy_counts(fact, "k", 0, max_keys=3)) == 3


def test_enrich_salts_all_three_joins(plain_joins):
    spark = plain_joins
    i = F.col("id")
    fact = spark.range(3000).select(
        i.alias("order_id"), F.when(i % 3 > 0, F.when(i % 3 == 1, 5).otherwise(i % 50)).cast("long").alias("customer_id"),
        (i % 7).alias("restaurant_id"), F.when(i % 2 == 0, i % 11).cast("long").alias("delivery_partner_id"))
    customers = spark.range(40).select(i.alias("customer_id"), *[F.lit("x").alias(c) for c in S.CUSTOMER_DIM_COLS[1:]])
    restaurants = spark.range(6).select(i.alias("restaurant_id"), *[F.lit("x").alias(c) for c in S.RESTAURANT_DIM_COLS[1:]])
    partners = spark.range(9).select(i.alias("delivery_partner_id"), *[F.lit("x").alias(c) for c in S.PARTNER_DIM_COLS[1:]])
    plain = S.enrich(fact, customers, restaurants, partners)
    salted = S.enrich(fact, customers, restaurants, partners, salt_rows=100)
    assert salted.columns == plain.columns and rows(salted) == rows(plain)
