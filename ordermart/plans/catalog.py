"""Registry of queries: key -> (Spark builder, DuckDB SQL twin or None).

Every builder takes ``(spark, sf_dir)``, derives the star schema from the
driver's tables and returns a lazy DataFrame over the WHOLE tables. Time
dependent inputs are pinned: ``as_of`` = AS_OF, load time ``now`` = NOW.
Source and sink keys do real I/O into the shared scratch folder
(``spark.checkpoint.dir``) and return what they read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions.calendar import days_since, local_load_time
from ..operators import extensions as X
from ..operators import history as H
from ..operators import marts as M
from ..operators import quality as Q
from ..operators import silver as S
from ..schemas import CORRUPT_COL, CUSTOMER_DIM_COLS, PARTNER_DIM_COLS, RESTAURANT_DIM_COLS
from ..session import materialize, scratch_path
from ..sinks import writers
from ..sinks.writers import write_raw_csv
from ..sources import bronze, raw
from ..sources.adapter import TIEBREAK_COLS, star_schema
from . import oracle as O
from .oracle import AS_OF, NOW, q

Builder = Callable[[SparkSession, str], DataFrame]
# buckets of the keys that exercise the bucketed paths
MANY_BUCKETS = 64


@dataclass
class Ctx:
    """Lazily built layers for one (session, tables) pair."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def star(self):
        return star_schema(self.spark, self.sf_dir)

    @cached_property
    def dedup(self) -> DataFrame:
        return S.dedup(self.star.orders, order_by=TIEBREAK_COLS).drop(*TIEBREAK_COLS)

    @cached_property
    def cleaned(self) -> DataFrame:
        return S.clean(self.star.orders, order_by=TIEBREAK_COLS, drop=TIEBREAK_COLS)

    @cached_property
    def flagged(self) -> DataFrame:
        return Q.classify(self.cleaned)

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return Q.split(self.flagged)

    @property
    def clean(self) -> DataFrame:
        return self.split[0]

    @property
    def quarantine(self) -> DataFrame:
        return self.split[1]

    @cached_property
    def history(self) -> DataFrame:
        """The history of the clean orders' keys and amounts. Staged first, so the
        two counts that look for heavy customers do not run the dedup again."""
        return S.with_history(materialize(
            self.clean.select("order_id", "customer_id", "order_date", "final_amount"), "clean-orders"))

    @cached_property
    def history_split(self) -> DataFrame:
        """Every customer through the bucketed (skew-safe) path, whatever its
        size, in many buckets: the operator-level window keys use it, so the
        oracle checks the path that big customers take at scale. Staged first,
        so the sample and the windows do not run the dedup again."""
        return H.customer_history(materialize(self.clean, "clean-orders"), buckets=MANY_BUCKETS)

    def enrich(self, df: DataFrame) -> DataFrame:
        st = self.star
        return S.enrich(df, st.customers, st.restaurants, st.partners)

    @cached_property
    def silver(self) -> DataFrame:
        st = self.star
        s, _ = S.build_silver(st.orders, st.customers, st.restaurants, st.partners, now=NOW,
                              order_by=TIEBREAK_COLS, drop=TIEBREAK_COLS)
        return s

    @cached_property
    def mart_silver(self) -> DataFrame:
        """The silver columns that the marts read; no others are staged."""
        st = self.star
        return S.build_silver_parts(st.orders, st.customers, st.restaurants, st.partners, now=NOW,
                                    broadcast_dims=True, order_by=TIEBREAK_COLS, drop=TIEBREAK_COLS,
                                    columns=M.MART_COLS)["silver"]


REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(key: str, sql: str | None):
    def deco(fn: Callable[[Ctx], DataFrame]):
        REGISTRY[key] = (lambda spark, sf_dir: fn(Ctx(spark, sf_dir)), sql)
        return fn
    return deco


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    """Instants as wall-clock ``timestamp_ntz`` (session-zone independent output)."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# ------------------------------------------------------------- SQL pieces --

def _dq_summary_sql() -> str:
    flags = [r[0] for r in rules.DQ_RULES] + [rules.UNKNOWN_STATUS_FLAG]
    parts = ["SELECT 'total_records' AS metric, COUNT(*) AS value FROM flagged",
             "SELECT 'valid_records', COUNT(*) FILTER (WHERE dq_flag = 'OK') FROM flagged",
             "SELECT 'quarantine_records', COUNT(*) FILTER (WHERE dq_flag <> 'OK') FROM flagged"]
    parts += [f"SELECT '{f}', COUNT(*) FILTER (WHERE dq_flag = '{f}') FROM flagged" for f in flags]
    return "\nUNION ALL ".join(parts)


MART_SQL = {
    "gold_order_summary": f"""
        SELECT *, {O.pct('delivered_orders', 'total_orders')} AS delivery_rate_pct,
                  {O.pct('cancelled_orders', 'total_orders')} AS cancellation_rate_pct
        FROM (SELECT COUNT(order_id) AS total_orders,
                     COUNT(DISTINCT customer_id) AS total_customers,
                     COUNT(DISTINCT restaurant_id) AS total_restaurants,
                     COUNT(DISTINCT delivery_partner_id) AS total_partners,
                     {O.sum_money('final_amount')} AS total_revenue,
                     {O.avg_money('final_amount')} AS avg_order_value,
                     COUNT(CASE WHEN order_status = 'DELIVERED' THEN 1 END) AS delivered_orders,
                     COUNT(CASE WHEN order_status = 'CANCELLED' THEN 1 END) AS cancelled_orders
              FROM silver)""",
    "gold_revenue_city": f"""
        SELECT delivery_city, COUNT(order_id) AS total_orders,
               COUNT(DISTINCT customer_id) AS customers,
               {O.sum_money('final_amount')} AS total_revenue,
               {O.avg_money('final_amount')} AS avg_order_value
        FROM silver GROUP BY delivery_city""",
    "gold_restaurant_performance": f"""
        SELECT *, CAST(dense_rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER)
                  AS restaurant_rank
        FROM (SELECT restaurant_id, restaurant_name, cuisine_type, delivery_city,
                     COUNT(order_id) AS total_orders,
                     {O.sum_money('final_amount')} AS total_revenue,
                     {O.avg_exact('rating')} AS avg_rating,
                     {O.avg_int('delivery_time_minutes')} AS avg_delivery_time
              FROM silver GROUP BY 1, 2, 3, 4)""",
    "gold_customer_rfm": f"""
        WITH g AS (
          SELECT customer_id, customer_name, city, loyalty_tier,
                 max(order_date) AS last_order_date, COUNT(order_id) AS frequency,
                 {O.sum_money('final_amount')} AS monetary
          FROM silver GROUP BY 1, 2, 3, 4),
        r AS (SELECT *, CAST(date_diff('day', last_order_date, DATE '{AS_OF}') AS INTEGER) AS recency
              FROM g),
        s AS (SELECT *,
                CASE WHEN recency <= 7 THEN 5 WHEN recency <= 30 THEN 4 WHEN recency <= 60 THEN 3
                     WHEN recency <= 120 THEN 2 ELSE 1 END AS recency_score,
                CAST(ntile(5) OVER (ORDER BY frequency DESC NULLS LAST, customer_id ASC NULLS FIRST)
                     AS INTEGER) AS frequency_score,
                CAST(ntile(5) OVER (ORDER BY monetary DESC NULLS LAST, customer_id ASC NULLS FIRST)
                     AS INTEGER) AS monetary_score
              FROM r),
        t AS (SELECT *, recency_score + frequency_score + monetary_score AS rfm_score FROM s)
        SELECT *, CASE WHEN rfm_score >= 13 THEN 'Champion' WHEN rfm_score >= 10 THEN 'Loyal'
                       WHEN rfm_score >= 7 THEN 'Potential' WHEN rfm_score >= 5 THEN 'At Risk'
                       ELSE 'Lost' END AS segment
        FROM t""",
    "gold_top_customers": f"""
        SELECT * FROM (
          SELECT *, CAST(dense_rank() OVER (ORDER BY total_spend DESC NULLS LAST) AS INTEGER)
                    AS customer_rank
          FROM (SELECT customer_id, customer_name, city,
                       {O.sum_money('final_amount')} AS total_spend,
                       COUNT(order_id) AS total_orders
                FROM silver GROUP BY 1, 2, 3))
        WHERE customer_rank <= 100""",
    "gold_partner_performance": f"""
        SELECT *, CASE WHEN avg_rating >= 4.5 AND avg_delivery_time <= 30 THEN 'STAR'
                       WHEN avg_rating >= 4.0 THEN 'EXCELLENT'
                       WHEN avg_rating >= 3.5 THEN 'GOOD' ELSE 'POOR' END AS performance_tier
        FROM (SELECT delivery_partner_id, partner_name, vehicle_type,
                     COUNT(order_id) AS deliveries,
                     {O.avg_int('delivery_time_minutes')} AS avg_delivery_time,
                     {O.avg_exact('rating')} AS avg_rating
              FROM silver WHERE order_status = 'DELIVERED' GROUP BY 1, 2, 3)""",
    "gold_payment_analysis": f"""
        SELECT payment_method, COUNT(order_id) AS orders,
               {O.sum_money('final_amount')} AS revenue,
               {O.avg_money('final_amount')} AS avg_order_value
        FROM silver GROUP BY payment_method""",
    "gold_peak_hours": f"""
        SELECT CAST(hour(order_timestamp) AS INTEGER) AS order_hour, COUNT(order_id) AS orders,
               {O.sum_money('final_amount')} AS revenue
        FROM silver GROUP BY 1""",
    "gold_monthly_trends": f"""
        WITH g AS (SELECT strftime(order_date, '%Y-%m') AS order_month, COUNT(order_id) AS orders,
                          SUM({O.units('final_amount')}) AS cents,
                          COUNT(DISTINCT customer_id) AS customers
                   FROM silver GROUP BY 1),
        l AS (SELECT *, lag(cents) OVER (ORDER BY order_month) AS prev FROM g)
        SELECT order_month, orders, CAST(cents AS DOUBLE) / 100 AS revenue, customers,
               CAST(prev AS DOUBLE) / 100 AS prev_month_revenue,
               {O.half_up('cents - prev', 'prev', 2, 1, 100)} AS revenue_growth_pct
        FROM l""",
    "gold_delivery_analysis": f"""
        SELECT delivery_city, vehicle_type,
               {O.avg_int('delivery_time_minutes')} AS avg_delivery_time,
               COUNT(CASE WHEN delivery_speed_category = 'FAST' THEN 1 END) AS fast_deliveries,
               COUNT(CASE WHEN delivery_speed_category = 'MEDIUM' THEN 1 END) AS medium_deliveries,
               COUNT(CASE WHEN delivery_speed_category = 'SLOW' THEN 1 END) AS slow_deliveries
        FROM silver GROUP BY 1, 2""",
    "gold_customer_retention": """
        SELECT customer_id, COUNT(DISTINCT strftime(order_date, '%Y-%m')) AS active_months
        FROM silver GROUP BY customer_id""",
    "gold_cuisine_performance": f"""
        SELECT cuisine_type, COUNT(order_id) AS orders,
               {O.sum_money('final_amount')} AS revenue,
               {O.avg_exact('rating', 1)} AS avg_rating
        FROM silver GROUP BY cuisine_type""",
}


def mart_sql(name: str) -> str:
    return q(f"SELECT * FROM ({MART_SQL[name]})")


MART_BUILDERS = {
    "gold_order_summary": M.order_summary,
    "gold_revenue_city": M.revenue_by_city,
    "gold_restaurant_performance": M.restaurant_performance,
    "gold_customer_rfm": lambda s: M.customer_rfm(s, AS_OF),
    "gold_top_customers": M.top_customers,
    "gold_partner_performance": M.partner_performance,
    "gold_payment_analysis": M.payment_analysis,
    "gold_peak_hours": M.peak_hours,
    "gold_monthly_trends": M.monthly_trends,
    "gold_delivery_analysis": M.delivery_analysis,
    "gold_customer_retention": M.customer_retention,
    "gold_cuisine_performance": M.cuisine_performance,
}

KPI_KEYS = {
    "kpi_order_summary": "gold_order_summary",
    "kpi_revenue_city": "gold_revenue_city",
    "kpi_restaurant_performance": "gold_restaurant_performance",
    "kpi_customer_rfm": "gold_customer_rfm",
    "kpi_top_customers": "gold_top_customers",
    "kpi_partner_performance": "gold_partner_performance",
    "kpi_payment_analysis": "gold_payment_analysis",
    "kpi_peak_hours": "gold_peak_hours",
    "kpi_monthly_trends": "gold_monthly_trends",
    "kpi_delivery_analysis": "gold_delivery_analysis",
    "kpi_customer_retention": "gold_customer_retention",
    "kpi_cuisine_performance": "gold_cuisine_performance",
}

for _key, _mart in KPI_KEYS.items():
    register(_key, mart_sql(_mart))(lambda c, _m=_mart: MART_BUILDERS[_m](c.silver))


# ------------------------------------------------------------ silver keys --

@register("silver_dedup", q("SELECT * FROM dedup"))
def _silver_dedup(c: Ctx) -> DataFrame:
    return c.dedup


@register("silver_fillna", q("SELECT * FROM filled"))
def _silver_fillna(c: Ctx) -> DataFrame:
    return S.fill_defaults(c.dedup)


@register("fn_city_norm", q("SELECT order_id, delivery_city AS raw_city, "
                            "upper(trim(delivery_city)) AS delivery_city FROM dedup"))
def _fn_city_norm(c: Ctx) -> DataFrame:
    return c.dedup.select("order_id", F.col("delivery_city").alias("raw_city"),
                          S.normalise_city("delivery_city").alias("delivery_city"))


@register("silver_final_amount", q("SELECT order_id, order_amount, discount_amount, "
                                   "tip_amount, final_amount FROM cleaned"))
def _silver_final(c: Ctx) -> DataFrame:
    return c.cleaned.select("order_id", "order_amount", "discount_amount", "tip_amount",
                            "final_amount")


@register("silver_typed", q("SELECT * FROM cleaned"))
def _silver_typed(c: Ctx) -> DataFrame:
    return c.cleaned


@register("dq_flags", q("SELECT * FROM flagged"))
def _dq_flags(c: Ctx) -> DataFrame:
    return c.flagged


@register("silver_clean", q("SELECT * FROM clean"))
def _silver_clean(c: Ctx) -> DataFrame:
    return c.clean


@register("silver_quarantine", q("SELECT * FROM quarantine"))
def _silver_quarantine(c: Ctx) -> DataFrame:
    return c.quarantine


@register("dq_summary", q(_dq_summary_sql()))
def _dq_summary(c: Ctx) -> DataFrame:
    return Q.summary(c.flagged)


def _join_sql(dim: str, key: str, cols: list[str]) -> str:
    sel = ", ".join(f"d.{x}" for x in cols if x != key)
    return q(f"SELECT o.*, {sel} FROM clean o LEFT JOIN {dim} d ON o.{key} = d.{key}")


@register("join_orders_customers", _join_sql("customers_raw", "customer_id", CUSTOMER_DIM_COLS))
def _join_customers(c: Ctx) -> DataFrame:
    return c.clean.join(c.star.customers.select(*CUSTOMER_DIM_COLS), "customer_id", "left")


@register("join_orders_restaurants",
          _join_sql("restaurants_raw", "restaurant_id", RESTAURANT_DIM_COLS))
def _join_restaurants(c: Ctx) -> DataFrame:
    return c.clean.join(c.star.restaurants.select(*RESTAURANT_DIM_COLS), "restaurant_id", "left")


@register("join_orders_partners",
          _join_sql("partners_raw", "delivery_partner_id", PARTNER_DIM_COLS))
def _join_partners(c: Ctx) -> DataFrame:
    return c.clean.join(c.star.partners.select(*PARTNER_DIM_COLS), "delivery_partner_id", "left")


_ENRICHED_FROM_CLEAN = """
  SELECT o.*, c.customer_name, c.gender, c.age, c.city, c.signup_date, c.loyalty_tier,
         r.restaurant_name, r.cuisine_type, r.avg_preparation_time,
         p.partner_name, p.vehicle_type, p.joining_date
  FROM clean o
  LEFT JOIN customers_raw c ON o.customer_id = c.customer_id
  LEFT JOIN restaurants_raw r ON o.restaurant_id = r.restaurant_id
  LEFT JOIN partners_raw p ON o.delivery_partner_id = p.delivery_partner_id"""


@register("silver_enriched", q(_ENRICHED_FROM_CLEAN))
def _silver_enriched(c: Ctx) -> DataFrame:
    return c.enrich(c.clean)


@register("join_broadcast_hint", q(_ENRICHED_FROM_CLEAN))
def _join_broadcast(c: Ctx) -> DataFrame:
    st = c.star
    return S.enrich(c.clean, st.customers, st.restaurants, st.partners, broadcast_dims=True)


@register("silver_bands", q("""
    SELECT order_id, delivery_time_minutes,
           CASE WHEN delivery_time_minutes <= 30 THEN 'FAST'
                WHEN delivery_time_minutes <= 60 THEN 'MEDIUM' ELSE 'SLOW' END
             AS delivery_speed_category,
           final_amount, CASE WHEN final_amount >= 1000 THEN 1 ELSE 0 END AS high_value_order
    FROM clean"""))
def _silver_bands(c: Ctx) -> DataFrame:
    return S.derive(c.clean).select("order_id", "delivery_time_minutes",
                                    "delivery_speed_category", "final_amount",
                                    "high_value_order")


@register("silver_calendar", q("""
    SELECT order_id, order_date,
           CASE WHEN dayofweek(order_date) IN (0, 6) THEN true ELSE false END AS is_weekend
    FROM clean"""))
def _silver_calendar(c: Ctx) -> DataFrame:
    return S.derive(c.clean).select("order_id", "order_date", "is_weekend")


@register("win_customer_order_number",
          q("SELECT order_id, customer_id, order_date, customer_order_number FROM hist"))
def _win_order_number(c: Ctx) -> DataFrame:
    return c.history_split.select("order_id", "customer_id", "order_date", "customer_order_number")


@register("win_previous_order_amount",
          q("SELECT order_id, customer_id, final_amount, previous_order_amount FROM hist"))
def _win_previous(c: Ctx) -> DataFrame:
    return c.history_split.select("order_id", "customer_id", "final_amount", "previous_order_amount")


@register("win_running_revenue",
          q("SELECT order_id, customer_id, order_date, running_customer_revenue FROM hist"))
def _win_running(c: Ctx) -> DataFrame:
    return c.history_split.select("order_id", "customer_id", "order_date", "running_customer_revenue")


_HEAVY_HIST = f"""
    , c AS (SELECT * EXCLUDE (customer_id), CASE WHEN customer_id % 3 <> 0 THEN customer_id END
              AS customer_id FROM clean)
    SELECT order_id, customer_id,
      CAST(row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS INTEGER)
        AS customer_order_number,
      lag(final_amount) OVER (PARTITION BY customer_id ORDER BY order_date, order_id)
        AS previous_order_amount,
      CAST(SUM({O.units('final_amount')}) OVER (PARTITION BY customer_id ORDER BY order_date
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 100
        AS running_customer_revenue
    FROM c"""


@register("win_history_null_heavy", q(_HEAVY_HIST))
def _win_null_heavy(c: Ctx) -> DataFrame:
    # a third of the orders has no customer: NULL is a heavy key, beside plain ones
    rows = c.clean.withColumn("customer_id", F.when(F.col("customer_id") % 3 != 0,
                                                    F.col("customer_id")))
    out = H.customer_history_hybrid(materialize(rows, "null-heavy"), heavy_rows=30,
                                    buckets=MANY_BUCKETS)
    return out.select("order_id", "customer_id", *H.OUT_COLS)


@register("silver_orders", q("SELECT * FROM silver"))
def _silver_orders(c: Ctx) -> DataFrame:
    return ntz(c.silver, "silver_load_time")


@register("fn_local_load_time", q("SELECT order_id, silver_load_time FROM silver"))
def _fn_load_time(c: Ctx) -> DataFrame:
    return ntz(c.clean.select("order_id", local_load_time(NOW).alias("silver_load_time")),
               "silver_load_time")


@register("rfm_recency", q(f"""
    SELECT customer_id, last_order_date,
           CAST(date_diff('day', last_order_date, DATE '{AS_OF}') AS INTEGER) AS recency,
           CASE WHEN date_diff('day', last_order_date, DATE '{AS_OF}') <= 7 THEN 5
                WHEN date_diff('day', last_order_date, DATE '{AS_OF}') <= 30 THEN 4
                WHEN date_diff('day', last_order_date, DATE '{AS_OF}') <= 60 THEN 3
                WHEN date_diff('day', last_order_date, DATE '{AS_OF}') <= 120 THEN 2
                ELSE 1 END AS recency_score
    FROM (SELECT customer_id, max(order_date) AS last_order_date FROM silver GROUP BY 1)"""))
def _rfm_recency(c: Ctx) -> DataFrame:
    g = c.silver.groupBy("customer_id").agg(F.max("order_date").alias("last_order_date"))
    g = g.withColumn("recency", days_since(AS_OF, "last_order_date"))
    return g.withColumn("recency_score", M.recency_score(F.col("recency")))


@register("rfm_segments", q(f"SELECT customer_id, rfm_score, segment FROM "
                            f"({MART_SQL['gold_customer_rfm']})"))
def _rfm_segments(c: Ctx) -> DataFrame:
    # bucket-parallel tiles regardless of size (the path large inputs take)
    return M.customer_rfm(c.silver, AS_OF, small_rows=0, buckets=MANY_BUCKETS).select(
        "customer_id", "rfm_score", "segment")


@register("sort_revenue_city",
          q(f"SELECT * FROM ({MART_SQL['gold_revenue_city']}) ORDER BY total_revenue DESC"))
def _sort_revenue_city(c: Ctx) -> DataFrame:
    return M.present("gold_revenue_city", M.revenue_by_city(c.silver))


@register("dq_orphans", q("""
    SELECT 'customers' AS dimension, COUNT(*) AS orphan_orders,
           COUNT(DISTINCT o.customer_id) AS orphan_keys
    FROM clean o WHERE o.customer_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM customers_raw d WHERE d.customer_id = o.customer_id)
    UNION ALL
    SELECT 'restaurants', COUNT(*), COUNT(DISTINCT o.restaurant_id)
    FROM clean o WHERE o.restaurant_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM restaurants_raw d WHERE d.restaurant_id = o.restaurant_id)
    UNION ALL
    SELECT 'partners', COUNT(*), COUNT(DISTINCT o.delivery_partner_id)
    FROM clean o WHERE o.delivery_partner_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM partners_raw d
                      WHERE d.delivery_partner_id = o.delivery_partner_id)"""))
def _dq_orphans(c: Ctx) -> DataFrame:
    st = c.star
    return Q.orphans(c.clean, {"customers": (st.customers, "customer_id"),
                               "restaurants": (st.restaurants, "restaurant_id"),
                               "partners": (st.partners, "delivery_partner_id")})


# ------------------------------------------------------------ extensions --

@register("ext_daily_summary", q(f"""
    SELECT order_date, COUNT(order_id) AS orders, {O.sum_money('final_amount')} AS revenue,
           COUNT(CASE WHEN order_status = 'DELIVERED' THEN 1 END) AS delivered_orders,
           COUNT(CASE WHEN order_status = 'CANCELLED' THEN 1 END) AS cancelled_orders,
           COUNT(CASE WHEN order_status = 'RETURNED' THEN 1 END) AS returned_orders
    FROM silver GROUP BY order_date"""))
def _ext_daily(c: Ctx) -> DataFrame:
    return X.daily_summary(c.silver)


@register("ext_city_mom", q(f"""
    , g AS (SELECT delivery_city, strftime(order_date, '%Y-%m') AS order_month,
                   COUNT(order_id) AS orders, SUM({O.units('final_amount')}) AS cents
            FROM silver GROUP BY 1, 2),
    l AS (SELECT *, lag(cents) OVER (PARTITION BY delivery_city ORDER BY order_month) AS prev
          FROM g)
    SELECT delivery_city, order_month, orders, CAST(cents AS DOUBLE) / 100 AS revenue,
           CAST(prev AS DOUBLE) / 100 AS prev_month_revenue,
           {O.half_up('cents - prev', 'prev', 2, 1, 100)} AS revenue_growth_pct
    FROM l"""))
def _ext_city_mom(c: Ctx) -> DataFrame:
    return X.city_month_over_month(c.silver)


@register("ext_restaurant_completion", q(f"""
    SELECT *, {O.pct('delivered_orders', 'total_orders')} AS completion_rate_pct
    FROM (SELECT restaurant_id, restaurant_name, COUNT(order_id) AS total_orders,
                 COUNT(CASE WHEN order_status = 'DELIVERED' THEN 1 END) AS delivered_orders
          FROM silver GROUP BY 1, 2)"""))
def _ext_completion(c: Ctx) -> DataFrame:
    return X.restaurant_completion(c.silver)


@register("ext_partner_speed_rank", q(f"""
    SELECT *, CAST(dense_rank() OVER (ORDER BY avg_delivery_time ASC NULLS FIRST) AS INTEGER)
              AS global_speed_rank
    FROM ({MART_SQL['gold_partner_performance']})"""))
def _ext_speed_rank(c: Ctx) -> DataFrame:
    # bucket-parallel dense rank regardless of size (the path large inputs take)
    return X.partner_speed_rank(c.silver, small_rows=0, buckets=MANY_BUCKETS)


@register("ext_meal_heatmap", q(f"""
    SELECT CAST(hour(order_timestamp) AS INTEGER) AS order_hour,
           CASE WHEN hour(order_timestamp) BETWEEN 5 AND 10 THEN 'BREAKFAST'
                WHEN hour(order_timestamp) BETWEEN 11 AND 15 THEN 'LUNCH'
                WHEN hour(order_timestamp) BETWEEN 16 AND 18 THEN 'SNACKS'
                WHEN hour(order_timestamp) BETWEEN 19 AND 22 THEN 'DINNER'
                ELSE 'LATE_NIGHT' END AS meal_period,
           COUNT(order_id) AS orders, {O.sum_money('final_amount')} AS revenue
    FROM silver GROUP BY 1, 2"""))
def _ext_meal(c: Ctx) -> DataFrame:
    return X.meal_heatmap(c.silver)


@register("ext_spend_trend", q("""
    SELECT order_id, customer_id, final_amount, previous_order_amount,
           CASE WHEN customer_order_number = 1 THEN 'FIRST'
                WHEN final_amount > previous_order_amount THEN 'UP'
                WHEN final_amount < previous_order_amount THEN 'DOWN'
                ELSE 'FLAT' END AS spend_trend
    FROM hist"""))
def _ext_spend_trend(c: Ctx) -> DataFrame:
    return X.spend_trend(c.history)


@register("ext_cohort_retention", q("""
    , cm AS (SELECT DISTINCT customer_id, date_trunc('month', order_date) AS m FROM silver),
    f AS (SELECT customer_id, m, min(m) OVER (PARTITION BY customer_id) AS first_m FROM cm)
    SELECT strftime(first_m, '%Y-%m') AS cohort_month,
           CAST((year(m) * 12 + month(m)) - (year(first_m) * 12 + month(first_m)) AS INTEGER)
             AS month_offset,
           COUNT(*) AS customers
    FROM f GROUP BY 1, 2"""))
def _ext_cohort(c: Ctx) -> DataFrame:
    return X.cohort_retention(c.silver)


@register("ext_cuisine_discount", q(f"""
    , g AS (SELECT cuisine_type, COUNT(order_id) AS orders,
                   SUM({O.units('discount_amount')}) AS dc, SUM({O.units('order_amount')}) AS ac
            FROM silver GROUP BY 1),
    t AS (SELECT *, SUM(orders) OVER () AS all_orders FROM g)
    SELECT cuisine_type, orders, {O.pct('orders', 'all_orders')} AS order_share_pct,
           CAST(dc AS DOUBLE) / 100 AS total_discount, {O.pct('dc', 'ac')} AS discount_share_pct
    FROM t"""))
def _ext_cuisine_discount(c: Ctx) -> DataFrame:
    return X.cuisine_discount(c.silver)


@register("ext_customer_dense_rank", q("""
    SELECT order_id, customer_id, final_amount,
           CAST(dense_rank() OVER (PARTITION BY customer_id ORDER BY final_amount DESC NULLS LAST)
                AS INTEGER) AS spend_rank
    FROM silver"""))
def _ext_dense_rank(c: Ctx) -> DataFrame:
    # every customer through the bucketed path (the one heavy customers take)
    return X.customer_dense_rank(c.silver, heavy_rows=0, buckets=MANY_BUCKETS)


# ------------------------------------------------------- sources / sinks --

_ORDERS_RAW_SQL = q(f"SELECT {O.RAW_COLS}, tb1, tb2, tb3, tb4 FROM orders_raw")


@register("src_csv_orders", _ORDERS_RAW_SQL)
def _src_csv(c: Ctx) -> DataFrame:
    orders = c.star.orders
    path = scratch_path(c.spark, "raw-orders-csv")
    write_raw_csv(orders, path)
    return raw.read_csv(c.spark, path, orders.schema)


@register("bronze_audit", q(f"""
    SELECT {O.RAW_COLS}, tb1, tb2, tb3, tb4, TIMESTAMP '{NOW}' AS ingestion_timestamp,
           'raw-orders-csv' AS source_folder, 'bronze' AS bronze_layer
    FROM orders_raw"""))
def _bronze_audit(c: Ctx) -> DataFrame:
    orders = c.star.orders
    path = scratch_path(c.spark, "raw-orders-csv")
    write_raw_csv(orders, path)
    b = bronze.ingest_csv(c.spark, path, orders.schema, now=NOW)
    # the path of a file, without the run's own part of its folder's name
    folder = F.regexp_extract("source_file", r"/([a-z-]+)-[0-9a-f]{32}/part-[^/]+\.csv$", 1)
    return ntz(b, "ingestion_timestamp").withColumn("source_folder", folder).drop(
        "source_file", CORRUPT_COL)


# raw values that no column type can hold, each by a rule on the order id
_BROKEN = {"order_amount": (11, "1,500.0"), "order_date": (13, "soon"), "customer_id": (17, "x12")}
_BROKEN_SQL = " OR ".join(f"order_id % {m} = 0" for m, _ in _BROKEN.values())


@register("src_csv_malformed", q(f"""
    , d AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY tb1, tb2, tb3, tb4) AS rn_
            FROM orders_raw WHERE NOT ({_BROKEN_SQL})),
    m AS (SELECT COUNT(*) AS n FROM orders_raw WHERE {_BROKEN_SQL}),
    f AS (SELECT *, {O.DQ_CASE} AS dq_flag FROM (
            SELECT *, round(order_amount - coalesce(discount_amount, 0.0) + coalesce(tip_amount, 0.0), 2)
              AS final_amount FROM d WHERE rn_ = 1))
    SELECT 'rows_in' AS metric, COUNT(*) AS value FROM orders_raw
    UNION ALL SELECT 'malformed', n FROM m
    UNION ALL SELECT 'valid', COUNT(*) FROM f WHERE dq_flag = 'OK'
    UNION ALL SELECT 'quarantine', COUNT(*) FILTER (dq_flag <> 'OK') + (SELECT n FROM m) FROM f
    UNION ALL SELECT 'merged_duplicates', COUNT(*) FROM d WHERE rn_ > 1
    UNION ALL SELECT 'records_kept', n FROM m"""))
def _src_malformed(c: Ctx) -> DataFrame:
    orders = c.star.orders
    text = orders.withColumns({
        name: F.when(F.col("order_id") % m == 0, F.lit(bad)).otherwise(F.col(name).cast("string"))
        for name, (m, bad) in _BROKEN.items()})
    path = write_raw_csv(text, scratch_path(c.spark, "raw-orders-csv"), compression="gzip")
    rows = materialize(raw.read_csv(c.spark, path, orders.schema, corrupt=True), "bronze-orders")
    flagged = S.flagged_orders(rows, order_by=TIEBREAK_COLS, drop=TIEBREAK_COLS)
    flag = F.col("dq_flag")
    totals = flagged.agg(
        F.count_if(flag == rules.MALFORMED_FLAG).alias("malformed"),
        F.count_if(flag == rules.OK_FLAG).alias("valid"),
        F.count_if(flag != rules.OK_FLAG).alias("quarantine"),
        F.count(F.lit(1)).alias("after"), F.count(CORRUPT_COL).alias("records_kept"))
    wide = rows.agg(F.count(F.lit(1)).alias("rows_in")).join(totals).withColumn(
        "merged_duplicates", F.col("rows_in") - F.col("after")).drop("after")  # single rows
    return wide.unpivot([], wide.columns, "metric", "value")


@register("src_csv_dimensions", q("""
    SELECT 'customers' AS source, customer_id AS id, customer_name AS name, city, loyalty_tier AS kind,
           signup_date AS since, 'bronze' AS bronze_layer FROM customers_raw
    UNION ALL SELECT 'restaurants', restaurant_id, restaurant_name, city, cuisine_type, NULL, 'bronze'
    FROM restaurants_raw
    UNION ALL SELECT 'partners', delivery_partner_id, partner_name, city, vehicle_type, joining_date,
           'bronze' FROM partners_raw"""))
def _src_dimensions(c: Ctx) -> DataFrame:
    cols = {"customers": ("customer_id", "customer_name", "loyalty_tier", "signup_date"),
            "restaurants": ("restaurant_id", "restaurant_name", "cuisine_type", None),
            "partners": ("delivery_partner_id", "partner_name", "vehicle_type", "joining_date")}
    paths = {n: write_raw_csv(df, scratch_path(c.spark, f"raw-{n}-csv"))
             for n, df in c.star.as_dict().items() if n in cols}
    read = bronze.ingest_all(c.spark, paths, NOW, {n: c.star.as_dict()[n].schema for n in paths})
    out = None
    for n, (key, name, kind, since) in cols.items():
        part = read[n].select(F.lit(n).alias("source"), F.col(key).alias("id"), F.col(name).alias("name"),
                              "city", F.col(kind).alias("kind"),
                              (F.col(since) if since else F.lit(None).cast("date")).alias("since"),
                              "bronze_layer")
        out = part if out is None else out.unionByName(part)
    return out

@register("src_path_scan", _ORDERS_RAW_SQL)
def _src_path(c: Ctx) -> DataFrame:
    path = writers.write_overwrite(c.star.orders, scratch_path(c.spark, "bronze-orders"))
    return raw.read_path(c.spark, path)


@register("src_table_scan", q("SELECT * FROM quarantine"))
def _src_table(c: Ctx) -> DataFrame:
    db = "ordermart_scratch"
    writers.ensure_database(c.spark, db, scratch_path(c.spark, "db"))
    writers.save_table(c.quarantine, f"{db}.quarantine_orders",
                       scratch_path(c.spark, "quarantine"))
    return raw.read_table(c.spark, f"{db}.quarantine_orders")


@register("snk_roundtrip", mart_sql("gold_payment_analysis"))
def _snk_roundtrip(c: Ctx) -> DataFrame:
    path = writers.write_overwrite(M.payment_analysis(c.silver),
                                   scratch_path(c.spark, "payment-analysis"))
    return raw.read_path(c.spark, path)


@register("snk_partitioned", q("SELECT * FROM silver"))
def _snk_partitioned(c: Ctx) -> DataFrame:
    path = writers.write_partitioned(ntz(c.silver, "silver_load_time"),
                                     scratch_path(c.spark, "silver"), ["delivery_city"])
    return raw.read_path(c.spark, path, text_partitions=["delivery_city"])


@register("snk_table", mart_sql("gold_cuisine_performance"))
def _snk_table(c: Ctx) -> DataFrame:
    db = "ordermart_scratch"
    writers.ensure_database(c.spark, db, scratch_path(c.spark, "db"))
    writers.save_table(M.cuisine_performance(c.silver), f"{db}.gold_cuisine_performance",
                       scratch_path(c.spark, "gold-cuisine"))
    return c.spark.table(f"{db}.gold_cuisine_performance")


@register("publish_marts", q("\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM ({body})"
    for name, body in MART_SQL.items())))
def _publish(c: Ctx) -> DataFrame:
    from ..plans.pipeline import persist_silver
    silver = persist_silver(c.mart_silver, scratch_path(c.spark, "silver-store"))
    # as pipeline.run: builders published by concurrent jobs
    builders = {name: (lambda b=b: b(silver)) for name, b in MART_BUILDERS.items()}
    paths = writers.publish(builders, scratch_path(c.spark, "gold"), parallelism=4)
    return writers.manifest({name: raw.read_path(c.spark, p) for name, p in paths.items()})


def _scratch_db(spark: SparkSession) -> str:
    db = f"ordermart_{uuid.uuid4().hex[:8]}"
    writers.ensure_database(spark, db, scratch_path(spark, "db"))
    return db


@register("publish_catalog", q("\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM ({body})"
    for name, body in MART_SQL.items())))
def _publish_catalog(c: Ctx) -> DataFrame:
    silver = materialize(c.mart_silver, "silver-store")
    db, root = _scratch_db(c.spark), scratch_path(c.spark, "gold")
    writers.publish({name: (lambda b=b: b(silver)) for name, b in MART_BUILDERS.items()}, root, db,
                    parallelism=4)
    return writers.manifest({name: c.spark.table(f"{db}.{name}") for name in MART_BUILDERS})


_SHOWN = ("gold_payment_analysis", "gold_peak_hours", "gold_revenue_city")


@register("show_tables", q("\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, false AS is_temporary, COUNT(*) AS row_count FROM ({MART_SQL[name]})"
    for name in _SHOWN)))
def _show_tables(c: Ctx) -> DataFrame:
    db = _scratch_db(c.spark)
    silver = materialize(c.mart_silver, "silver-store")
    writers.publish({n: MART_BUILDERS[n](silver) for n in _SHOWN}, scratch_path(c.spark, "gold"), db)
    shown = writers.list_tables(c.spark, db).filter(F.col("namespace") == db).select(
        F.col("tableName").alias("table_name"), F.col("isTemporary").alias("is_temporary"))
    return shown.join(writers.manifest({n: c.spark.table(f"{db}.{n}") for n in _SHOWN}), "table_name")


@register("preview_limit", q(f"SELECT * FROM ({MART_SQL['gold_revenue_city']}) "
                             f"ORDER BY total_revenue DESC LIMIT 5"))
def _preview(c: Ctx) -> DataFrame:
    return M.present("gold_revenue_city", M.revenue_by_city(c.silver), limit=5)


@register("table_manifest", q("""
    SELECT 'bronze_orders' AS table_name, COUNT(*) AS row_count FROM orders_raw
    UNION ALL SELECT 'bronze_customers', COUNT(*) FROM customers_raw
    UNION ALL SELECT 'bronze_restaurants', COUNT(*) FROM restaurants_raw
    UNION ALL SELECT 'bronze_partners', COUNT(*) FROM partners_raw
    UNION ALL SELECT 'silver_orders', COUNT(*) FROM clean
    UNION ALL SELECT 'quarantine_orders', COUNT(*) FROM quarantine"""))
def _manifest(c: Ctx) -> DataFrame:
    st = c.star
    return writers.manifest({
        "bronze_orders": st.orders, "bronze_customers": st.customers,
        "bronze_restaurants": st.restaurants, "bronze_partners": st.partners,
        "silver_orders": c.clean, "quarantine_orders": c.quarantine,
    })


# --------------------------------------------------------- ad-hoc SQL --

@register("sql_city_counts",
          q("SELECT delivery_city, COUNT(*) AS orders FROM silver GROUP BY delivery_city"))
def _sql_city_counts(c: Ctx) -> DataFrame:
    c.silver.createOrReplaceTempView("silver_orders")
    return c.spark.sql("SELECT delivery_city, COUNT(*) AS orders FROM silver_orders "
                       "GROUP BY delivery_city")


@register("sql_rfm_top10", q(f"SELECT * FROM ({MART_SQL['gold_customer_rfm']}) "
                             f"ORDER BY rfm_score DESC, customer_id LIMIT 10"))
def _sql_rfm_top10(c: Ctx) -> DataFrame:
    M.customer_rfm(c.silver, AS_OF).createOrReplaceTempView("gold_customer_rfm")
    # the pipeline's query has no tiebreak; customer_id makes LIMIT deterministic
    return c.spark.sql("SELECT * FROM gold_customer_rfm "
                       "ORDER BY rfm_score DESC, customer_id LIMIT 10")


@register("sql_revenue_city_sorted", q(f"SELECT * FROM ({MART_SQL['gold_revenue_city']}) "
                                       f"ORDER BY total_revenue DESC"))
def _sql_revenue_sorted(c: Ctx) -> DataFrame:
    M.revenue_by_city(c.silver).createOrReplaceTempView("gold_revenue_city")
    return c.spark.sql("SELECT * FROM gold_revenue_city ORDER BY total_revenue DESC")


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


from . import catalog_evolving  # noqa: E402,F401  (registers its keys)
