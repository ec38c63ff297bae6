"""DuckDB SQL twins of the registered queries (the correctness oracle).

Only the driver's base tables are registered in DuckDB, so every statement
carries the star-schema adapter and the silver chain as CTEs. Money follows
the same exact-cents rules as ``functions.money`` so that both engines produce
bit-identical doubles; ranks and tiles use a total order where the Spark side
does, and are cast to INTEGER like Spark's.
"""

from __future__ import annotations

AS_OF = "2001-08-02"
NOW = "2001-08-02 00:00:00"

# ------------------------------------------------------------ SQL helpers --


def units(x: str, scale: int = 100) -> str:
    return f"CAST(round({x} * {scale}) AS BIGINT)"


def sum_money(x: str) -> str:
    return f"CAST(SUM({units(x)}) AS DOUBLE) / 100"


def half_up(n: str, d: str, digits: int = 2, num_scale: int = 1, factor: int = 1) -> str:
    p = 10 ** digits
    hn = f"CAST({n} AS HUGEINT)"
    hd = f"abs(CAST({d} AS HUGEINT)) * {num_scale}"
    q = f"((abs({hn}) * {2 * factor * p} + {hd}) // (2 * {hd}))"
    neg = f"(({n}) < 0) <> (({d}) < 0)"
    return (f"(CASE WHEN ({d}) <> 0 THEN CAST((CASE WHEN {neg} THEN -{q} ELSE {q} END) "
            f"AS DOUBLE) / {p} END)")


def avg_money(x: str, digits: int = 2, scale: int = 100) -> str:
    return half_up(f"SUM({units(x, scale)})", f"COUNT({x})", digits, scale)


def avg_exact(x: str, digits: int = 2) -> str:
    """Average of decimal values with up to six digits, rounded HALF_UP."""
    total = f"CAST(SUM(CAST({x} AS DECIMAL(20, 6))) * 1000000 AS HUGEINT)"
    return half_up(total, f"COUNT({x})", digits, 1000000)


def avg_int(x: str, digits: int = 2) -> str:
    return half_up(f"SUM({x})", f"COUNT({x})", digits)


def pct(a: str, b: str) -> str:
    return half_up(a, b, 2, 1, 100)


# ------------------------------------------------------------------- CTEs --

ADAPTER = """
orders_raw AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_id,
         CASE WHEN l_orderkey % 19 <> 0 THEN o_custkey END AS customer_id,
         CASE WHEN l_partkey % 23 <> 0 THEN l_suppkey END AS restaurant_id,
         CASE WHEN l_suppkey % 29 <> 0 THEN l_partkey END AS delivery_partner_id,
         CAST(o_orderdate AS DATE) AS order_date,
         o_orderdate + to_hours(CAST(l_partkey % 24 AS INTEGER)) AS order_timestamp,
         ' ' || lower(n_name) || ' ' AS delivery_city,
         o_orderpriority AS payment_method,
         CASE WHEN o_orderstatus = 'F' THEN 'DELIVERED'
              WHEN o_orderstatus = 'O' THEN 'CANCELLED'
              WHEN l_returnflag = 'R' THEN 'RETURNED'
              ELSE 'PARTIAL' END AS order_status,
         CAST(abs(date_diff('day', o_orderdate, l_shipdate)) % 200 AS INTEGER) AS delivery_time_minutes,
         CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 200000 - 5000 AS DOUBLE) / 100 AS order_amount,
         CASE WHEN l_tax = 0 THEN NULL ELSE round(l_tax * 1000) END AS tip_amount,
         CASE WHEN l_discount = 0 THEN NULL ELSE round(l_discount * 3000) END AS discount_amount,
         CASE WHEN l_quantity < 4 THEN NULL ELSE round(l_quantity / 9.0, 2) END AS rating,
         l_partkey AS tb1, l_suppkey AS tb2, l_extendedprice AS tb3, l_shipdate AS tb4
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
customers_raw AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(18 + c_custkey % 43 AS INTEGER) AS age,
         n_name AS city, DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS signup_date,
         c_mktsegment AS loyalty_tier
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 13 <> 5
),
restaurants_raw AS (
  SELECT s_suppkey AS restaurant_id, s_name AS restaurant_name, r_name AS cuisine_type,
         n_name AS city, CAST(10 + s_suppkey % 36 AS INTEGER) AS avg_preparation_time,
         CAST(10 + s_suppkey % 41 AS DOUBLE) / 10 AS restaurant_rating
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE s_suppkey % 11 <> 3
),
partners_raw AS (
  SELECT p_partkey AS delivery_partner_id, p_name AS partner_name, p_type AS vehicle_type,
         DATE '1992-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS joining_date, p_brand AS city
  FROM part WHERE p_partkey % 17 <> 4
)"""

RAW_COLS = ("order_id, customer_id, restaurant_id, delivery_partner_id, order_date, "
            "order_timestamp, delivery_city, payment_method, order_status, "
            "delivery_time_minutes, order_amount, tip_amount, discount_amount, rating")

DQ_CASE = """CASE WHEN order_amount <= 0 THEN 'INVALID_AMOUNT'
            WHEN final_amount < 0 THEN 'NEGATIVE_FINAL'
            WHEN delivery_time_minutes > 180 THEN 'EXCESS_DELIVERY_TIME'
            WHEN rating > 5 THEN 'INVALID_RATING'
            WHEN NOT (order_status IN ('DELIVERED', 'CANCELLED', 'RETURNED')) THEN 'UNKNOWN_STATUS'
            ELSE 'OK' END"""

CHAIN = f"""
dedup AS (
  SELECT {RAW_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY tb1, tb2, tb3, tb4) AS rn_
    FROM orders_raw) WHERE rn_ = 1
),
filled AS (
  SELECT order_id, customer_id, restaurant_id, delivery_partner_id, order_date, order_timestamp,
         delivery_city, payment_method, order_status, delivery_time_minutes, order_amount,
         coalesce(tip_amount, 0.0) AS tip_amount, coalesce(discount_amount, 0.0) AS discount_amount,
         coalesce(rating, 0.0) AS rating
  FROM dedup
),
cleaned AS (
  SELECT order_id, customer_id, restaurant_id, delivery_partner_id, order_date, order_timestamp,
         upper(trim(delivery_city)) AS delivery_city, payment_method, order_status,
         delivery_time_minutes, order_amount, tip_amount, discount_amount, rating,
         round(order_amount - discount_amount + tip_amount, 2) AS final_amount
  FROM filled
),
flagged AS (SELECT *, {DQ_CASE} AS dq_flag FROM cleaned),
clean AS (SELECT * EXCLUDE (dq_flag) FROM flagged WHERE dq_flag = 'OK'),
quarantine AS (SELECT * FROM flagged WHERE dq_flag <> 'OK'),
hist AS (
  SELECT *,
    CAST(row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS INTEGER)
      AS customer_order_number,
    lag(final_amount) OVER (PARTITION BY customer_id ORDER BY order_date, order_id)
      AS previous_order_amount,
    CAST(SUM({units('final_amount')}) OVER (PARTITION BY customer_id ORDER BY order_date
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 100
      AS running_customer_revenue
  FROM clean
),
enriched AS (
  SELECT o.delivery_partner_id, o.restaurant_id, o.customer_id, o.order_id, o.order_date,
         o.order_timestamp, o.delivery_city, o.payment_method, o.order_status,
         o.delivery_time_minutes, o.order_amount, o.tip_amount, o.discount_amount, o.rating,
         o.final_amount, o.customer_order_number, o.previous_order_amount,
         o.running_customer_revenue,
         c.customer_name, c.gender, c.age, c.city, c.signup_date, c.loyalty_tier,
         r.restaurant_name, r.cuisine_type, r.avg_preparation_time,
         p.partner_name, p.vehicle_type, p.joining_date
  FROM hist o
  LEFT JOIN customers_raw c ON o.customer_id = c.customer_id
  LEFT JOIN restaurants_raw r ON o.restaurant_id = r.restaurant_id
  LEFT JOIN partners_raw p ON o.delivery_partner_id = p.delivery_partner_id
),
silver AS (
  SELECT *,
    CASE WHEN delivery_time_minutes <= 30 THEN 'FAST'
         WHEN delivery_time_minutes <= 60 THEN 'MEDIUM' ELSE 'SLOW' END AS delivery_speed_category,
    CASE WHEN final_amount >= 1000 THEN 1 ELSE 0 END AS high_value_order,
    CASE WHEN dayofweek(order_date) IN (0, 6) THEN true ELSE false END AS is_weekend,
    timezone('Asia/Kolkata', TIMESTAMPTZ '{NOW}+00') AS silver_load_time
  FROM enriched
)"""


def q(body: str) -> str:
    """A full statement: adapter + silver chain CTEs + ``body``.

    ``body`` may start with ``, name AS (...)`` to add further CTEs before its
    final SELECT.
    """
    body = body.strip()
    if body.startswith(","):
        return f"WITH {ADAPTER},{CHAIN}{body}"
    return f"WITH {ADAPTER},{CHAIN}\n{body}"
