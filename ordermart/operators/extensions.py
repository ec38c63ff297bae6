"""Marts the pipeline's documentation describes but its code never built.

Definitions are ours (the documentation names them only); each is plain
DataFrame work over the silver fact, with the same exact-cents money rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import hour_of, meal_period, month_label
from ..functions.money import half_up_ratio, pct, sum_money, units
from ..session import materialize
from . import marts
from .ranks import SMALL_RANK_ROWS, dense_rank_within, global_dense_rank


def _status_count(status: str):
    return F.count(F.when(F.col("order_status") == status, F.lit(1)))


def daily_summary(silver: DataFrame) -> DataFrame:
    """Per order date: volume, revenue and status breakdown."""
    return silver.groupBy("order_date").agg(
        F.count("order_id").alias("orders"),
        sum_money("final_amount").alias("revenue"),
        _status_count("DELIVERED").alias("delivered_orders"),
        _status_count("CANCELLED").alias("cancelled_orders"),
        _status_count("RETURNED").alias("returned_orders"),
    )


def city_month_over_month(silver: DataFrame) -> DataFrame:
    """City x month revenue with the city's previous month and growth %.

    The lag is partitioned by city over the aggregated (city, month) rows, so
    a partition holds at most one row per calendar month.
    """
    g = silver.groupBy("delivery_city", month_label("order_date").alias("order_month")).agg(
        F.count("order_id").alias("orders"),
        F.sum(units("final_amount")).alias("_cents"),
    )
    g = g.withColumn("_prev", F.lag("_cents").over(
        Window.partitionBy("delivery_city").orderBy("order_month")))
    return g.select(
        "delivery_city", "order_month", "orders",
        (F.col("_cents").cast("double") / 100).alias("revenue"),
        (F.col("_prev").cast("double") / 100).alias("prev_month_revenue"),
        half_up_ratio(F.col("_cents") - F.col("_prev"), F.col("_prev"), factor=100)
        .alias("revenue_growth_pct"),
    )


def restaurant_completion(silver: DataFrame) -> DataFrame:
    """Delivered share of each restaurant's orders."""
    g = silver.groupBy("restaurant_id", "restaurant_name").agg(
        F.count("order_id").alias("total_orders"),
        _status_count("DELIVERED").alias("delivered_orders"),
    )
    return g.withColumn("completion_rate_pct",
                        pct(F.col("delivered_orders"), F.col("total_orders")))


def partner_speed_rank(silver: DataFrame, small_rows: int = SMALL_RANK_ROWS,
                       buckets: int | None = None) -> DataFrame:
    """Partner KPI plus ``global_speed_rank`` (dense rank, fastest first)."""
    perf = materialize(marts.partner_performance(silver), "partner-performance")
    return global_dense_rank(perf, "avg_delivery_time", descending=False,
                             out="global_speed_rank", buckets=buckets,
                             small_rows=small_rows)


def meal_heatmap(silver: DataFrame) -> DataFrame:
    """Orders and revenue per hour x meal period."""
    return silver.groupBy(hour_of("order_timestamp").alias("order_hour"),
                          meal_period("order_timestamp").alias("meal_period")).agg(
        F.count("order_id").alias("orders"),
        sum_money("final_amount").alias("revenue"),
    )


def spend_trend(silver: DataFrame) -> DataFrame:
    """FIRST / UP / DOWN / FLAT against the customer's previous order."""
    prev, cur = F.col("previous_order_amount"), F.col("final_amount")
    trend = (F.when(F.col("customer_order_number") == 1, F.lit("FIRST"))
             .when(cur > prev, F.lit("UP")).when(cur < prev, F.lit("DOWN"))
             .otherwise(F.lit("FLAT")))
    return silver.select("order_id", "customer_id", "final_amount", "previous_order_amount",
                         trend.alias("spend_trend"))


def cohort_retention(silver: DataFrame) -> DataFrame:
    """Distinct customers per (first-order month, months since).

    Reduced to distinct (customer, month) pairs first (map-side), so the
    per-customer window sees at most one row per calendar month.
    """
    cm = silver.select("customer_id", F.trunc("order_date", "month").alias("_m")).distinct()
    cm = cm.withColumn("_first", F.min("_m").over(Window.partitionBy("customer_id")))
    offset = ((F.year("_m") * 12 + F.month("_m")) - (F.year("_first") * 12 + F.month("_first")))
    return cm.groupBy(month_label("_first").alias("cohort_month"),
                      offset.cast("int").alias("month_offset")).agg(
        F.count(F.lit(1)).alias("customers"))


def cuisine_discount(silver: DataFrame) -> DataFrame:
    """Per cuisine: order share, total discount and discount share of amount."""
    g = silver.groupBy("cuisine_type").agg(
        F.count("order_id").alias("orders"),
        F.sum(units("discount_amount")).alias("_dc"),
        F.sum(units("order_amount")).alias("_ac"),
    )
    # one row per cuisine: the grand total window is over a handful of rows
    g = g.withColumn("_all", F.sum("orders").over(Window.partitionBy()))
    return g.select(
        "cuisine_type", "orders",
        pct(F.col("orders"), F.col("_all")).alias("order_share_pct"),
        (F.col("_dc").cast("double") / 100).alias("total_discount"),
        pct(F.col("_dc"), F.col("_ac")).alias("discount_share_pct"),
    )


def customer_dense_rank(silver: DataFrame, heavy_rows: int | None = None,
                        buckets: int | None = None) -> DataFrame:
    """Dense rank of each order's amount within its customer (largest = 1)."""
    base = silver.select("order_id", "customer_id", "final_amount")
    return dense_rank_within(base, "customer_id", "final_amount", descending=True,
                             out="spend_rank", buckets=buckets, heavy_rows=heavy_rows)
