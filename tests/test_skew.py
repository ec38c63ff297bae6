"""Skew on real data: a third of the sf0.01 orders moved onto ONE customer and
many copies of ONE order id, derived from the driver's tables."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01, rows
from ordermart.operators import history as H
from ordermart.operators import marts as M
from ordermart.operators import ranks as R
from ordermart.operators import silver as S
from ordermart.sources.adapter import TIEBREAK_COLS, star_schema

HOT = 1


@pytest.fixture(scope="module")
def skewed(spark):
    st = star_schema(spark, SF01)
    third = F.col("tb1") % 3 == 0  # about a third of all lines
    orders = st.orders.withColumn("customer_id", F.when(third, F.lit(HOT)).otherwise(
        F.col("customer_id")))
    # and one order id with thousands of copies
    orders = orders.withColumn("order_id", F.when(F.col("tb2") % 7 == 0, F.lit(-1)).otherwise(
        F.col("order_id")))
    return st, orders


def test_dedup_reduces_hot_id_before_the_shuffle(spark, skewed):
    _, orders = skewed
    d = S.dedup(orders, order_by=TIEBREAK_COLS)
    plan = d._jdf.queryExecution().executedPlan().toString()
    # top-down: final group limit, the exchange, then a PARTIAL group limit
    # below it, so the copies collapse map-side before the shuffle
    final = plan.index("row_number(), 1, Final")
    exchange = plan.index("Exchange hashpartitioning(order_id", final)
    assert plan.index("row_number(), 1, Partial", exchange) > exchange
    hot = d.filter("order_id = -1").collect()
    assert len(hot) == 1
    best = orders.filter("order_id = -1").orderBy(*TIEBREAK_COLS).first()
    assert hot[0].tb1 == best.tb1 and hot[0].tb3 == best.tb3


def test_history_splits_hot_customer_and_matches_window(spark, skewed):
    st, orders = skewed
    flagged = S.flagged_orders(orders, order_by=TIEBREAK_COLS, drop=TIEBREAK_COLS)
    clean = flagged.filter("dq_flag = 'OK'").drop("dq_flag").cache()
    n_hot = clean.filter(F.col("customer_id") == HOT).count()
    assert n_hot > clean.count() / 4
    assert H.heavy_keys(clean, "customer_id", 1000) == [HOT]
    cols = ["order_id"] + H.OUT_COLS
    ref = rows(H.customer_history_window(clean), cols)
    hybrid = H.customer_history_hybrid(clean, heavy_rows=1000, buckets=24)
    assert rows(hybrid, cols) == ref
    b = R.with_buckets(clean, [("customer_id", False), ("order_date", False),
                               ("order_id", False)], buckets=24)
    per = [r["count"] for r in b.filter(F.col("customer_id") == HOT)
           .groupBy("_bkt").count().collect()]
    assert len(per) >= 6 and max(per) < n_hot / 3


def test_marts_on_skewed_silver(spark, skewed):
    st, orders = skewed
    silver, _ = S.build_silver(orders, st.customers, st.restaurants, st.partners,
                               now="2001-08-02 00:00:00", heavy_rows=1000,
                               order_by=TIEBREAK_COLS, drop=TIEBREAK_COLS)
    rfm = M.customer_rfm(silver, "2001-08-02", small_rows=0)
    g = silver.groupBy("customer_id").agg(F.count("order_id").alias("frequency"))
    ref = {r.customer_id: r.t for r in g.withColumn("t", F.ntile(5).over(
        Window.orderBy(F.col("frequency").desc(), "customer_id"))).collect()}
    got = {r.customer_id: r.frequency_score for r in rfm.collect()}
    assert got == ref and got[HOT] == 1
    top = {r.customer_id for r in M.top_customers(silver, k=3).collect()}
    assert HOT in top


def test_aqe_splits_hot_customer_join_when_dimensions_are_large(spark, skewed):
    st, orders = skewed
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",  # as if dimensions were huge
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             # AQE's skew thresholds scaled down to this data size
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        silver, _ = S.build_silver(orders, st.customers, st.restaurants, st.partners,
                                   heavy_rows=1000, order_by=TIEBREAK_COLS,
                                   drop=TIEBREAK_COLS)
        silver.collect()
        plan = silver._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert "isFinalPlan=true" in plan
        assert any("SortMergeJoin(skew=true)" in line and "customer_id" in line
                   for line in final.split("\n"))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
