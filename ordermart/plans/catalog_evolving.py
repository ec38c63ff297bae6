"""Registered queries of what changes over time: inferred and drifting schemas,
incremental history and marts, sketches, versions and published sets. Same
contract as ``catalog``, which imports this module."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..operators import activity, sketches, skew_join
from ..operators import marts as M
from ..operators import silver as S
from ..operators.history import OUT_COLS
from ..operators.incremental_history import HistoryStore
from ..operators.mart_states import MartStates
from ..schemas import CUSTOMER_DIM_COLS
from ..session import materialize, scratch_path
from ..sinks import releases, writers
from ..sinks.evolving import EvolvingTable
from ..sinks.writers import write_raw_csv
from ..sources import inference as I
from .catalog import MART_BUILDERS, MART_SQL, Ctx, mart_sql, register
from .oracle import AS_OF, q

# ------------------------------------------------------- inferred schema --

# Two variants of one raw feed: other column order, a column more, and values
# of several types in most columns, each by a rule on the order id.
_FEED_SQL = """
    feed AS (
      SELECT order_id AS k,
        CAST(order_id * (CASE WHEN order_id % 1000 = 7 THEN 10000000000 ELSE 1 END) AS VARCHAR) AS order_id,
        CAST(customer_id AS VARCHAR) AS customer_id,
        CAST(order_date AS VARCHAR) || (CASE WHEN order_id % 50 = 1 THEN ' 10:00:00' ELSE '' END) AS order_date,
        CAST(delivery_time_minutes AS VARCHAR) || (CASE WHEN order_id % 40 = 1 THEN '.5' ELSE '' END) AS minutes,
        CASE WHEN order_id % 97 = 0 THEN 'n/a' WHEN order_id % 101 = 0 THEN 'none'
             ELSE CAST(delivery_time_minutes AS VARCHAR) END AS noisy,
        CASE WHEN order_id % 2 = 0 THEN 'true' ELSE 'FALSE' END AS is_gift,
        delivery_city AS city,
        CASE WHEN order_id % 3 = 0 THEN CASE WHEN order_id % 5 = 0 THEN 'app' ELSE 'web' END END AS channel
      FROM orders_raw)"""
_FEED = ("order_id", "customer_id", "order_date", "minutes", "noisy", "is_gift", "city", "channel")
_TOLERANCE = 0.05


def _feed(c: Ctx) -> I.Inferred | tuple[str, str]:
    """The feed's two folders of CSV files."""
    k, minutes = F.col("order_id"), F.col("delivery_time_minutes").cast("string")
    text = c.star.orders.select(
        k.alias("k"),
        (k * F.when(k % 1000 == 7, F.lit(10_000_000_000)).otherwise(F.lit(1))).cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.concat(F.col("order_date").cast("string"), F.when(k % 50 == 1, F.lit(" 10:00:00")).otherwise(F.lit(""))).alias("order_date"),
        F.concat(minutes, F.when(k % 40 == 1, F.lit(".5")).otherwise(F.lit(""))).alias("minutes"),
        F.when(k % 97 == 0, F.lit("n/a")).when(k % 101 == 0, F.lit("none")).otherwise(minutes).alias("noisy"),
        F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("FALSE")).alias("is_gift"),
        F.col("delivery_city").alias("city"),
        F.when(k % 5 == 0, F.lit("app")).otherwise(F.lit("web")).alias("channel"))
    old = text.filter(F.col("k") % 3 != 0).select(*_FEED[:-1])
    new = text.filter(F.col("k") % 3 == 0).select("channel", "city", "order_date", "order_id", "is_gift", "noisy", "minutes", "customer_id")
    return tuple(write_raw_csv(df, scratch_path(c.spark, f"feed-{n}-csv")) for n, df in (("old", old), ("new", new)))


def _kind_sql(v: str) -> str:
    return f"""CASE WHEN {v} IS NULL THEN NULL
      WHEN regexp_full_match({v}, '[+-]?[0-9]{{1,19}}') AND try_cast({v} AS INTEGER) IS NOT NULL THEN 'integer'
      WHEN regexp_full_match({v}, '[+-]?[0-9]{{1,19}}') AND try_cast({v} AS BIGINT) IS NOT NULL THEN 'long'
      WHEN regexp_full_match({v}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{{1,3}})?') THEN 'double'
      WHEN regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') AND try_cast({v} AS DATE) IS NOT NULL THEN 'date'
      WHEN regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}[ T][0-9]{{1,2}}:[0-9]{{1,2}}(:[0-9]{{1,2}}([.][0-9]{{1,6}})?)?')
        AND try_cast({v} AS TIMESTAMP) IS NOT NULL THEN 'timestamp'
      WHEN lower({v}) IN ('true', 'false') THEN 'boolean' ELSE 'string' END"""


def _fits_sql(kind: str) -> str:
    return " + ".join(f"n_{k}" for k in I.KINDS if k not in I.HOLDS[kind]) or "0"


# variants of the feed that have each column; the values of each, by kind
_KINDS_SQL = f"""
    , {_FEED_SQL},
    v AS ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, {i} AS position, {c} AS v FROM feed" for i, c in enumerate(_FEED))}),
    k AS (SELECT *, {_kind_sql('v')} AS kind FROM v),
    n AS (SELECT column_name, position, COUNT(v) AS n_values, COUNT(*) FILTER (v IS NULL) AS n_nulls,
            {', '.join(f"COUNT(*) FILTER (kind = '{k}') AS n_{k}" for k in I.KINDS)} FROM k GROUP BY 1, 2),
    t AS (SELECT *, CASE WHEN n_values = 0 THEN 'string'
            {' '.join(f"WHEN {_fits_sql(k)} = 0 THEN '{k}'" for k in I.KINDS[:-1])} ELSE 'string' END AS strict_kind FROM n)"""


@register("src_csv_inferred", q(_KINDS_SQL + f"""
    , l AS (SELECT column_name, position, n_values, n_nulls, {', '.join(f'n_{k}' for k in I.KINDS)}, strict_kind,
              CASE WHEN column_name = 'noisy' THEN 'integer' ELSE strict_kind END AS kind FROM t),
    r AS (SELECT k.column_name, COUNT(*) AS rejected, min(v) AS first_reject, max(v) AS last_reject
          FROM k WHERE column_name = 'noisy' AND kind <> 'integer' GROUP BY 1)
    SELECT l.column_name, kind, strict_kind, n_values, n_nulls, {', '.join(f'n_{k}' for k in I.KINDS)},
      coalesce(rejected, 0) AS rejected, first_reject, last_reject,
      CAST(CASE WHEN l.column_name = 'channel' THEN 1 ELSE 2 END AS INTEGER) AS variants
    FROM l LEFT JOIN r USING (column_name)"""))
def _src_inferred(c: Ctx) -> DataFrame:
    """Types of the feed, strict and with a tolerance, and what was rejected."""
    seen = I.survey(c.spark, _feed(c))
    strict = {x.name: x.kind for x in I.infer(c.spark, seen).columns}
    found = I.report(c.spark, I.infer(c.spark, seen, tolerance=_TOLERANCE))
    kinds = c.spark.createDataFrame(list(strict.items()), "column_name string, strict_kind string")
    return found.join(F.broadcast(kinds), "column_name").select(
        "column_name", "kind", "strict_kind", F.col("values").alias("n_values"), F.col("nulls").alias("n_nulls"),
        *[f"n_{k}" for k in I.KINDS], "rejected", F.get("examples", F.lit(0)).alias("first_reject"),
        F.when(F.size("examples") > 0, F.element_at("examples", -1)).alias("last_reject"), "variants")


@register("src_csv_inferred_rows", q(f"""
    , {_FEED_SQL}
    SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS INTEGER) AS customer_id,
      CAST(order_date AS TIMESTAMP) AS order_date, CAST(minutes AS DOUBLE) AS minutes, noisy,
      CAST(is_gift AS BOOLEAN) AS is_gift, city, channel FROM feed"""))
def _src_inferred_rows(c: Ctx) -> DataFrame:
    return I.read_inferred(c.spark, I.infer(c.spark, _feed(c)))


_DECLARED = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.DateType()), T.StructField("minutes", T.IntegerType()),
    T.StructField("noisy", T.IntegerType()), T.StructField("is_gift", T.DateType()),
    T.StructField("city", T.StringType()), T.StructField("coupon", T.StringType())])


@register("src_schema_drift", q(_KINDS_SQL + """
    SELECT column_name, CASE column_name WHEN 'customer_id' THEN 'narrower' WHEN 'channel' THEN 'added'
        WHEN 'is_gift' THEN 'changed' WHEN 'order_id' THEN 'moved' WHEN 'city' THEN 'moved' ELSE 'wider' END AS status,
      CASE column_name WHEN 'order_id' THEN 'long' WHEN 'customer_id' THEN 'long' WHEN 'order_date' THEN 'date'
        WHEN 'minutes' THEN 'integer' WHEN 'noisy' THEN 'integer' WHEN 'is_gift' THEN 'date' WHEN 'city' THEN 'string' END AS declared,
      strict_kind AS inferred,
      CASE column_name WHEN 'order_date' THEN n_timestamp WHEN 'minutes' THEN n_double WHEN 'noisy' THEN n_string
        WHEN 'is_gift' THEN n_boolean ELSE 0 END AS rejected
    FROM t UNION ALL SELECT 'coupon', 'missing', 'string', NULL, 0"""))
def _src_drift(c: Ctx) -> DataFrame:
    """What the feed has that a declared schema does not say."""
    return I.drift(c.spark, I.infer(c.spark, _feed(c)), _DECLARED)


# ------------------------------------------------------------ skewed join --

@register("join_skewed_customers", q("""
    , s AS (SELECT * EXCLUDE (customer_id), CASE WHEN order_id % 3 = 1 THEN 4
              WHEN order_id % 3 = 2 THEN customer_id END AS customer_id FROM clean)
    SELECT s.*, c.customer_name, c.gender, c.age, c.city, c.signup_date, c.loyalty_tier
    FROM s LEFT JOIN customers_raw c USING (customer_id)"""))
def _join_skewed(c: Ctx) -> DataFrame:
    """A third of the orders without a customer, a third of one customer: the
    salted shuffle join, whatever the dimension's size."""
    k = F.col("order_id") % 3
    fact = materialize(c.clean.withColumn("customer_id", F.when(k == 1, F.lit(4)).when(k == 2, F.col("customer_id"))
                                          .cast("long")), "skewed-orders")
    heavy = skew_join.heavy_counts(fact, "customer_id", 500)
    return skew_join.salted_left_join(fact, c.star.customers.select(*CUSTOMER_DIM_COLS), "customer_id", ["order_id"],
                                      {key: -(-n // 500) for key, n in heavy.items()})


@register("silver_enriched_salted", q("SELECT * FROM enriched"))
def _enriched_salted(c: Ctx) -> DataFrame:
    """The three joins of silver with salts for keys above 50 rows wherever the
    dimension is not broadcast."""
    st, stored = c.star, materialize(c.clean, "clean-orders")
    return S.enrich(S.with_history(stored), st.customers, st.restaurants, st.partners, salt_rows=50, counts_from=stored)


# ------------------------------------------------- incremental history --

@register("history_incremental", q("SELECT order_id, customer_id, order_date, final_amount, "
                                   "customer_order_number, previous_order_amount, running_customer_revenue FROM hist"))
def _history_incremental(c: Ctx) -> DataFrame:
    """All clean orders in four batches by year, every 53rd one batch late."""
    rows = materialize(c.clean.select("order_id", "customer_id", "order_date", "final_amount"), "clean-orders")
    low, high = rows.agg(F.min(F.year("order_date")), F.max(F.year("order_date"))).first()
    span = max(1, (high or 0) - (low or 0) + 1)
    batch = F.floor((F.year("order_date") - F.lit(low or 0)) * 3 / F.lit(span)) + F.when(F.col("order_id") % 53 == 0, 1).otherwise(0)
    store = HistoryStore(c.spark, scratch_path(c.spark, "history-store"))
    for i in range(4):
        store.advance(rows.filter(F.coalesce(batch, F.lit(0)) == i))
    return store.rows().select("order_id", "customer_id", "order_date", "final_amount", *OUT_COLS)


# ----------------------------------------------------- incremental marts --

def _state_mart(c: Ctx, name: str) -> DataFrame:
    """A mart from states of three batches; some rows were added twice and
    taken back."""
    silver, k = materialize(c.mart_silver, "state-silver"), F.col("order_id")
    states = MartStates(c.spark, scratch_path(c.spark, "mart-states"))
    states.add(silver.filter(k % 2 == 0))
    states.add(silver.filter((k % 2 == 1) | (k % 10 == 2)))
    states.compact()
    states.add(silver.filter(k % 10 == 2), sign=-1)
    return states.builders(AS_OF)[name]()


for _name in ("gold_order_summary", "gold_revenue_city", "gold_restaurant_performance", "gold_customer_rfm",
              "gold_monthly_trends", "gold_partner_performance"):
    register(f"state_{_name.removeprefix('gold_')}", mart_sql(_name))(lambda c, name=_name: _state_mart(c, name))


# ------------------------------------------------- activity and sketches --

@register("activity_retention", mart_sql("gold_customer_retention"))
def _activity_retention(c: Ctx) -> DataFrame:
    return activity.active_months(activity.activity(c.silver))


@register("activity_cohorts", q("""
    , m AS (SELECT DISTINCT customer_id, date_trunc('month', order_date) AS m FROM silver),
    f AS (SELECT *, min(m) OVER (PARTITION BY customer_id) AS f FROM m)
    SELECT strftime(f, '%Y-%m') AS cohort_month, CAST(date_diff('month', f, m) AS INTEGER) AS month_offset,
      COUNT(*) AS customers FROM f GROUP BY 1, 2"""))
def _activity_cohorts(c: Ctx) -> DataFrame:
    """Cohorts from the merged bit sets of two periods."""
    rows = materialize(c.silver.select("order_id", "customer_id", "order_date"), "activity-orders")
    parts = [activity.activity(rows.filter(F.col("order_id") % 2 == i)) for i in (0, 1)]
    return activity.cohorts(activity.merge(parts[0].unionByName(parts[1])))


_CUTS = ((), ("delivery_city",), ("order_month",), ("delivery_city", "order_month"))


@register("distinct_sketches", q(", r AS (SELECT *, strftime(order_date, '%Y-%m') AS order_month FROM silver)\n"
                                 + "\nUNION ALL ".join(f"""
    SELECT '{'/'.join(by) or 'all'}' AS cut, {', '.join(c if c in by else f"CAST(NULL AS VARCHAR) AS {c}" for c in sketches.GRAIN)},
      COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT restaurant_id) AS restaurants,
      COUNT(DISTINCT delivery_partner_id) AS partners, true AS within_bound
    FROM r {f"GROUP BY {', '.join(by)}" if by else ""}""" for by in _CUTS)))
def _distinct_sketches(c: Ctx) -> DataFrame:
    """Every cut's exact distinct counts, and whether the union of the stored
    sketches estimates all three within the stated bound."""
    silver = materialize(c.silver.select(*sketches.KEYS.values(), "delivery_city", "order_date"), "sketch-rows")
    stored, out = materialize(sketches.build(silver), "sketches"), None
    for by in _CUTS:
        estimate = sketches.cut(stored, by).select(*[F.col(b).alias(f"_{b}") for b in by],
                                                   *[F.col(n).alias(f"_{n}") for n in sketches.KEYS])
        same = F.lit(True)
        for b in by:
            same = same & F.col(b).eqNullSafe(F.col(f"_{b}"))
        close = F.lit(True)
        for n in sketches.KEYS:
            close = close & (F.abs(F.col(n) - F.col(f"_{n}")) <= F.greatest(F.lit(1.0), F.col(n) * sketches.ERROR_BOUND))
        part = sketches.exact_cut(silver, by).join(estimate, same, "left").select(
            F.lit("/".join(by) or "all").alias("cut"),
            *[(F.col(g) if g in by else F.lit(None).cast("string")).alias(g) for g in sketches.GRAIN],
            *sketches.KEYS, F.coalesce(close, F.lit(False)).alias("within_bound"))
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------ versions and releases --

@register("snk_evolving_schema", q("""
    SELECT CAST(0 AS INTEGER) AS version, order_id, CAST(order_date AS TIMESTAMP) AS order_date,
      CAST(delivery_time_minutes AS DOUBLE) AS minutes, CAST(NULL AS VARCHAR) AS payment_method FROM clean WHERE order_id % 3 = 0
    UNION ALL SELECT 1, order_id, order_date + INTERVAL 10 HOUR, delivery_time_minutes + 0.5, payment_method
    FROM clean WHERE order_id % 3 = 1
    UNION ALL SELECT 2, order_id, NULL, delivery_time_minutes, payment_method FROM clean WHERE order_id % 3 = 2"""))
def _evolving(c: Ctx) -> DataFrame:
    """Three versions: a column more and two widened ones, then a column less."""
    rows, k = materialize(c.clean, "clean-orders"), F.col("order_id") % 3
    minutes = F.col("delivery_time_minutes")
    table = EvolvingTable(c.spark, scratch_path(c.spark, "evolving"))
    table.write(rows.filter(k == 0).select("order_id", "order_date", minutes.alias("minutes")))
    table.write(rows.filter(k == 1).select(
        "payment_method", "order_id", (minutes + F.lit(0.5)).alias("minutes"),
        (F.col("order_date").cast("timestamp_ntz") + F.expr("INTERVAL 10 HOURS")).alias("order_date")))
    table.write(rows.filter(k == 2).select("order_id", minutes.alias("minutes"), "payment_method"))
    return table.read_all("version")


@register("publish_release", q("\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM ({body})" for name, body in MART_SQL.items())))
def _publish_release(c: Ctx) -> DataFrame:
    """Two runs of the marts under one switch; the second writes only some of
    them, the manifest carries the others."""
    silver, root = materialize(c.mart_silver, "silver-store"), scratch_path(c.spark, "gold-release")
    builders = {n: (lambda b=b: b(silver)) for n, b in MART_BUILDERS.items()}
    releases.publish_release(c.spark, builders, root, parallelism=4)
    releases.publish_release(c.spark, {n: builders[n] for n in ("gold_peak_hours", "gold_revenue_city")}, root)
    now = releases.current_release(c.spark, root)
    return writers.manifest({n: now.read(n) for n in now.tables})


# --------------------------------------------------- order of outputs --

_SORTED = {"gold_revenue_city": ("delivery_city", "total_revenue", True), "gold_peak_hours": ("order_hour", "order_hour", False)}


@register("present_positions", q("\nUNION ALL ".join(f"""
    SELECT '{n}' AS table_name, CAST({key} AS VARCHAR) AS item,
      row_number() OVER (ORDER BY {by} {'DESC NULLS LAST' if desc else 'NULLS FIRST'}) AS position
    FROM ({MART_SQL[n]})""" for n, (key, by, desc) in _SORTED.items())))
def _positions(c: Ctx) -> DataFrame:
    """The place of each row in the sorted marts as they are presented (written
    in order and numbered by file and place; one file, as the marts are small)."""
    out = None
    for n, (key, _, _) in _SORTED.items():
        shown = M.present(n, MART_BUILDERS[n](c.silver)).select(F.col(key).cast("string").alias("item")).coalesce(1)
        stored = materialize(shown, f"shown-{n}")
        at = Window.orderBy(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
        part = stored.select(F.lit(n).alias("table_name"), "item", F.row_number().over(at).cast("long").alias("position"))
        out = part if out is None else out.unionByName(part)
    return out
