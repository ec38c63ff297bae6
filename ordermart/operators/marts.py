"""Gold layer: the twelve KPI marts over the silver fact.

Every mart is scan -> partial aggregate -> shuffle on its group keys -> final
aggregate. Money uses exact cents (``functions.money``). Global ranks and tiles
go through ``ranks`` (bucket-parallel) instead of a single-partition window;
the only plain unpartitioned window left is the month-over-month ``lag`` in
``monthly_trends``, whose input has one row per calendar month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions.calendar import days_since, hour_of, month_label
from ..functions.money import avg_int, avg_money, half_up_ratio, pct, sum_money, units, MILLIONTHS
from ..session import materialize
from .ranks import SMALL_RANK_ROWS, global_dense_rank, global_ntile, top_k_with_ties


# the silver columns that the twelve marts (and their states) read; a copy that only
# serves them needs no other
MART_COLS = (
    "order_id", "order_date", "order_timestamp", "order_status", "delivery_city", "payment_method", "final_amount",
    "rating", "delivery_time_minutes", "delivery_speed_category", "customer_id", "customer_name", "city",
    "loyalty_tier", "restaurant_id", "restaurant_name", "cuisine_type", "delivery_partner_id", "partner_name",
    "vehicle_type")


def _count_if(cond: Column) -> Column:
    # count(when(cond, 1)): NULL conditions do not count
    return F.count(F.when(cond, F.lit(1)))


def order_summary(silver: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """KPI 1: one row, also on empty input."""
    keys = {"total_customers": "customer_id", "total_restaurants": "restaurant_id",
            "total_partners": "delivery_partner_id"}
    plain = [
        F.count("order_id").alias("total_orders"),
        sum_money("final_amount").alias("total_revenue"),
        avg_money("final_amount").alias("avg_order_value"),
        _count_if(F.col("order_status") == "DELIVERED").alias("delivered_orders"),
        _count_if(F.col("order_status") == "CANCELLED").alias("cancelled_orders"),
    ]
    if exact_distinct:
        # one distinct per column on its own pruned scan (several in one
        # aggregate would multiply the fact's rows); single rows, put together
        agg = silver.agg(*plain)
        for name, key in keys.items():
            agg = agg.unionByName(silver.select(key).distinct().agg(F.count(key).alias(name)),
                                  allowMissingColumns=True)
        agg = agg.agg(*[F.max(c).alias(c) for c in agg.columns])
    else:
        agg = silver.agg(*plain, *[F.approx_count_distinct(k).alias(n) for n, k in keys.items()])
    agg = agg.select("total_orders", *keys, *[c for c in agg.columns if c != "total_orders" and c not in keys])
    return with_rates(agg)


def with_rates(totals: DataFrame) -> DataFrame:
    """Delivery and cancellation percent of the order summary."""
    return totals.withColumns({
        "delivery_rate_pct": pct(F.col("delivered_orders"), F.col("total_orders")),
        "cancellation_rate_pct": pct(F.col("cancelled_orders"), F.col("total_orders")),
    })


def revenue_by_city(silver: DataFrame) -> DataFrame:
    """KPI 2 (sorted by revenue only when presented, see ``present``)."""
    return silver.groupBy("delivery_city").agg(
        F.count("order_id").alias("total_orders"),
        F.countDistinct("customer_id").alias("customers"),
        sum_money("final_amount").alias("total_revenue"),
        avg_money("final_amount").alias("avg_order_value"),
    )


def restaurant_performance(silver: DataFrame, small_rows: int = SMALL_RANK_ROWS) -> DataFrame:
    """KPI 3: per restaurant x name x cuisine x city, global dense rank by revenue."""
    g = silver.groupBy("restaurant_id", "restaurant_name", "cuisine_type", "delivery_city").agg(
        F.count("order_id").alias("total_orders"),
        sum_money("final_amount").alias("total_revenue"),
        avg_money("rating", scale=MILLIONTHS).alias("avg_rating"),
        avg_int("delivery_time_minutes").alias("avg_delivery_time"),
    )
    return restaurant_ranks(g, small_rows)


def restaurant_ranks(g: DataFrame, small_rows: int = SMALL_RANK_ROWS) -> DataFrame:
    """KPI 3's rank over its groups."""
    g = materialize(g, "restaurant-groups")  # read by the sample, rank and join passes
    return global_dense_rank(g, "total_revenue", descending=True, out="restaurant_rank",
                             small_rows=small_rows)


def recency_score(recency: Column) -> Column:
    expr = None
    for bound, score in rules.RECENCY_SCORES:
        expr = (F.when(recency <= bound, F.lit(score)) if expr is None
                else expr.when(recency <= bound, F.lit(score)))
    return expr.otherwise(F.lit(rules.RECENCY_OTHERWISE))


def rfm_segment(score: Column) -> Column:
    expr = None
    for bound, label in rules.RFM_SEGMENTS:
        expr = (F.when(score >= bound, F.lit(label)) if expr is None
                else expr.when(score >= bound, F.lit(label)))
    return expr.otherwise(F.lit(rules.RFM_OTHERWISE))


def customer_rfm(silver: DataFrame, as_of=None, bucket_order: str = "reference",
                 small_rows: int = SMALL_RANK_ROWS, buckets: int | None = None) -> DataFrame:
    """KPI 4: recency band + frequency and monetary tiles + segment.

    ``bucket_order="reference"`` keeps the pipeline's tiles (ordered
    DESCENDING, so the best customers get tile 1); ``"ascending"`` gives the
    conventional RFM where 5 is best. Tile ties break on the group keys.
    """
    g = silver.groupBy("customer_id", "customer_name", "city", "loyalty_tier").agg(
        F.max("order_date").alias("last_order_date"),
        F.count("order_id").alias("frequency"),
        sum_money("final_amount").alias("monetary"),
    )
    return rfm_scores(g, as_of, bucket_order, small_rows, buckets)


def rfm_scores(g: DataFrame, as_of=None, bucket_order: str = "reference",
               small_rows: int = SMALL_RANK_ROWS, buckets: int | None = None) -> DataFrame:
    """KPI 4's scores and segments over one row a customer."""
    g = g.withColumn("recency", days_since(as_of, "last_order_date"))
    g = g.withColumn("recency_score", recency_score(F.col("recency")))
    desc = bucket_order == "reference"
    # each tile pass reads its input three times (sample, local rank, counts):
    # read stored customer rows, not the silver aggregation again
    g = materialize(g, "rfm-customers")
    n = g.count()  # parquet metadata
    bucketed = small_rows <= 0 or n > small_rows
    # a duplicated dimension row gives two groups of one id: all group keys break ties
    ties = [(c, False) for c in ("customer_id", "customer_name", "city", "loyalty_tier")]
    g = global_ntile(g, rules.RFM_TILES, [("frequency", desc), *ties],
                     out="frequency_score", small_rows=small_rows, rows=n, buckets=buckets)
    if bucketed:
        # the bucketed tiles are a multi-pass plan; stage them before the
        # second tile reads its input three times
        g = materialize(g, "rfm-frequency")
    g = global_ntile(g, rules.RFM_TILES, [("monetary", desc), *ties],
                     out="monetary_score", small_rows=small_rows, rows=n, buckets=buckets)
    g = g.withColumn("rfm_score", F.col("recency_score") + F.col("frequency_score")
                     + F.col("monetary_score"))
    return g.withColumn("segment", rfm_segment(F.col("rfm_score"))).select(
        "customer_id", "customer_name", "city", "loyalty_tier", "last_order_date",
        "frequency", "monetary", "recency", "recency_score", "frequency_score",
        "monetary_score", "rfm_score", "segment")


def top_customers(silver: DataFrame, k: int = rules.TOP_CUSTOMERS) -> DataFrame:
    """KPI 5: dense rank by spend <= k (ties at the cut-off all kept)."""
    g = silver.groupBy("customer_id", "customer_name", "city").agg(
        sum_money("final_amount").alias("total_spend"),
        F.count("order_id").alias("total_orders"),
    )
    return top_spenders(g, k)


def top_spenders(g: DataFrame, k: int = rules.TOP_CUSTOMERS) -> DataFrame:
    """KPI 5's rank over one row a customer."""
    g = materialize(g, "customer-spend")  # read by the top-k pass and the join
    return top_k_with_ties(g, "total_spend", k, out="customer_rank")


def partner_tier(rating: Column, minutes: Column) -> Column:
    expr = F.when((rating >= rules.STAR_MIN_RATING) & (minutes <= rules.STAR_MAX_MINUTES),
                  F.lit(rules.STAR_TIER))
    for bound, label in rules.PARTNER_TIERS:
        expr = expr.when(rating >= bound, F.lit(label))
    return expr.otherwise(F.lit(rules.PARTNER_OTHERWISE))


def partner_performance(silver: DataFrame) -> DataFrame:
    """KPI 6: delivered orders only (filter pushed into the scan)."""
    g = (silver.filter(F.col("order_status") == "DELIVERED")
         .groupBy("delivery_partner_id", "partner_name", "vehicle_type").agg(
             F.count("order_id").alias("deliveries"),
             avg_int("delivery_time_minutes").alias("avg_delivery_time"),
             avg_money("rating", scale=MILLIONTHS).alias("avg_rating"),
         ))
    return g.withColumn("performance_tier",
                        partner_tier(F.col("avg_rating"), F.col("avg_delivery_time")))


def payment_analysis(silver: DataFrame) -> DataFrame:
    """KPI 7."""
    return silver.groupBy("payment_method").agg(
        F.count("order_id").alias("orders"),
        sum_money("final_amount").alias("revenue"),
        avg_money("final_amount").alias("avg_order_value"),
    )


def peak_hours(silver: DataFrame) -> DataFrame:
    """KPI 8: per hour of the order timestamp."""
    return silver.groupBy(hour_of("order_timestamp").alias("order_hour")).agg(
        F.count("order_id").alias("orders"),
        sum_money("final_amount").alias("revenue"),
    )


def monthly_trends(silver: DataFrame) -> DataFrame:
    """KPI 9: per month, previous month's revenue and growth %.

    The lag window has no partition key but runs over the aggregated months
    (one row per calendar month), so its single task is bounded by the
    calendar, not by the data. Growth is an exact HALF_UP ratio of cents;
    NULL for the first month and when the previous month's revenue is 0.
    """
    g = silver.groupBy(month_label("order_date").alias("order_month")).agg(
        F.count("order_id").alias("orders"),
        F.sum(units("final_amount")).alias("_cents"),
        F.countDistinct("customer_id").alias("customers"),
    )
    return month_growth(g)


def month_growth(g: DataFrame) -> DataFrame:
    """KPI 9's previous month and growth over one row a month."""
    w = Window.orderBy("order_month")
    g = g.withColumn("_prev", F.lag("_cents").over(w))
    return g.select(
        "order_month", "orders",
        (F.col("_cents").cast("double") / 100).alias("revenue"),
        "customers",
        (F.col("_prev").cast("double") / 100).alias("prev_month_revenue"),
        half_up_ratio(F.col("_cents") - F.col("_prev"), F.col("_prev"), digits=2,
                      factor=100).alias("revenue_growth_pct"),
    )


def delivery_analysis(silver: DataFrame) -> DataFrame:
    """KPI 10: per city x vehicle, average time and speed-band counts."""
    band = F.col("delivery_speed_category")
    return silver.groupBy("delivery_city", "vehicle_type").agg(
        avg_int("delivery_time_minutes").alias("avg_delivery_time"),
        _count_if(band == "FAST").alias("fast_deliveries"),
        _count_if(band == "MEDIUM").alias("medium_deliveries"),
        _count_if(band == "SLOW").alias("slow_deliveries"),
    )


def customer_retention(silver: DataFrame) -> DataFrame:
    """KPI 11: distinct active months per customer."""
    return silver.groupBy("customer_id").agg(
        F.countDistinct(month_label("order_date")).alias("active_months"))


def cuisine_performance(silver: DataFrame) -> DataFrame:
    """KPI 12 (rating rounded to ONE digit, as in the pipeline)."""
    return silver.groupBy("cuisine_type").agg(
        F.count("order_id").alias("orders"),
        sum_money("final_amount").alias("revenue"),
        avg_money("rating", digits=1, scale=MILLIONTHS).alias("avg_rating"),
    )


# name -> builder(silver, as_of)
MART_FUNCTIONS = {
    "gold_order_summary": lambda s, as_of=None: order_summary(s),
    "gold_revenue_city": lambda s, as_of=None: revenue_by_city(s),
    "gold_restaurant_performance": lambda s, as_of=None: restaurant_performance(s),
    "gold_customer_rfm": lambda s, as_of=None: customer_rfm(s, as_of),
    "gold_top_customers": lambda s, as_of=None: top_customers(s),
    "gold_partner_performance": lambda s, as_of=None: partner_performance(s),
    "gold_payment_analysis": lambda s, as_of=None: payment_analysis(s),
    "gold_peak_hours": lambda s, as_of=None: peak_hours(s),
    "gold_monthly_trends": lambda s, as_of=None: monthly_trends(s),
    "gold_delivery_analysis": lambda s, as_of=None: delivery_analysis(s),
    "gold_customer_retention": lambda s, as_of=None: customer_retention(s),
    "gold_cuisine_performance": lambda s, as_of=None: cuisine_performance(s),
}


def all_marts(silver: DataFrame, as_of=None) -> dict[str, DataFrame]:
    return {name: build(silver, as_of) for name, build in MART_FUNCTIONS.items()}


# Presentation order of the marts that the pipeline displays sorted.
# (column, descending)
PRESENT_ORDER = {
    "gold_revenue_city": [("total_revenue", True)],
    "gold_partner_performance": [("avg_rating", True)],
    "gold_peak_hours": [("order_hour", False)],
    "gold_customer_retention": [("active_months", True)],
}


def present(name: str, df: DataFrame, limit: int | None = None) -> DataFrame:
    """Sorted view for display (a stored table carries no order); with
    ``limit`` a bounded preview (a top-k, not a full sort, when ordered)."""
    order = PRESENT_ORDER.get(name)
    if order:
        df = df.orderBy(*[F.col(c).desc() if d else F.col(c).asc() for c, d in order])
    return df.limit(limit) if limit else df
