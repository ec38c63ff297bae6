"""The twelve marts kept up to date from day-grain additive states.

A state is a small aggregate of new silver rows whose measures add up: counts, cents,
rating units, minutes; sets are groups with a row count. ``MartStates.add`` turns a
batch (a day, a late day, a correction) into states and appends them; ``marts``
sums the states into the marts, without reading silver again. All measures are
integers, so the marts equal those built directly from all rows, to the last digit.

``add(rows, sign=-1)`` takes rows back (an order that was corrected or removed): all
measures subtract, groups without rows vanish, last days are found among the days
that still have orders.

Each batch is committed by one atomically created file; ``compact`` replaces all
batches by their sum, so the states grow with days and keys, not with batches.

The states of a large batch that have about as many groups as rows are stored in
buckets by the hash of their keys. The shuffle that sums a batch deals them so; no
later sum by the same keys (``compact``, the marts of single days) shuffles them again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import hour_of, month_label
from ..functions.money import MILLIONTHS, half_up_ratio, units, units_to_double
from ..sinks import manifests, writers
from . import marts as M
from .skew_join import estimated_bytes

BATCH = "batch-"
BUCKETS_FROM = 64 << 20  # bytes of a batch (by Spark's estimate); below, files would be tiny

ORDERS, CENTS = ("orders",), ("cents", "amounts")
RATING, MINUTES = ("rating_units", "ratings"), ("minutes", "timed")
TOTALS = ("cents", "rating_units", "minutes")
STATUS, BANDS = ("delivered", "cancelled"), ("fast", "medium", "slow")


def _measure(name: str) -> Column:
    """The integer that a row adds to a measure."""
    there = lambda c: F.col(c).isNotNull().cast("long")
    flag = lambda c, v: F.coalesce((F.col(c) == v).cast("long"), F.lit(0).cast("long"))
    known = {
        "orders": lambda: there("order_id"), "amounts": lambda: there("final_amount"), "ratings": lambda: there("rating"),
        "timed": lambda: there("delivery_time_minutes"), "cents": lambda: units("final_amount"),
        "rating_units": lambda: units("rating", MILLIONTHS), "minutes": lambda: F.col("delivery_time_minutes").cast("long")}
    if name in known:
        return known[name]()
    return flag("order_status" if name in STATUS else "delivery_speed_category", name.upper())


# state: (keys, measures, only delivered orders)
STATES: dict[str, tuple[tuple[str, ...], tuple[str, ...], bool]] = {
    "totals": (("order_date",), ORDERS + CENTS + STATUS, False),
    "city": (("order_date", "delivery_city"), ORDERS + CENTS, False),
    "city_customer": (("delivery_city", "customer_id"), (), False),
    "restaurant": (("order_date", "restaurant_id", "restaurant_name", "cuisine_type", "delivery_city"),
                   ORDERS + CENTS + RATING + MINUTES, False),
    "customer": (("order_date", "customer_id", "customer_name", "city", "loyalty_tier"), ORDERS + CENTS, False),
    "partner": (("order_date", "delivery_partner_id", "partner_name", "vehicle_type"), ORDERS + RATING + MINUTES, True),
    "partner_ids": (("delivery_partner_id",), (), False),
    "payment": (("order_date", "payment_method"), ORDERS + CENTS, False),
    "hour": (("order_date", "order_hour"), ORDERS + CENTS, False),
    "delivery": (("order_date", "delivery_city", "vehicle_type"), MINUTES + BANDS, False),
    "cuisine": (("order_date", "cuisine_type"), ORDERS + CENTS + RATING, False),
}


# states that are stored in buckets: an id or a vehicle in the key makes many groups
MANY_GROUPS = ("city_customer", "restaurant", "customer", "partner", "partner_ids", "delivery")


def build(silver: DataFrame, sign: int = 1) -> dict[str, DataFrame]:
    """The states of some silver rows; ``sign`` -1 takes them back."""
    rows = silver.withColumn("order_hour", hour_of("order_timestamp"))
    out = {}
    for name, (keys, measures, delivered) in STATES.items():
        part = rows.filter(F.col("order_status") == "DELIVERED") if delivered else rows
        # sums first, then the counts, that are mostly equal: side by side they compress best
        ordered = sorted(measures, key=lambda m: m not in TOTALS)
        sums = {m: F.sum(_measure(m)) for m in ordered} | {"n_rows": F.count(F.lit(1))}
        out[name] = part.groupBy(*keys).agg(*[(s * F.lit(sign)).alias(m) for m, s in sums.items()])
    return out


def _roll(state: DataFrame, *by: str) -> DataFrame:
    """Measures summed by some keys; groups that have no rows left go."""
    kept = [c for c in state.columns if c in _MEASURES]
    return state.groupBy(*by).agg(*[F.sum(c).alias(c) for c in kept]).filter(F.col("n_rows") > 0)


_MEASURES = {"n_rows"} | {m for _, ms, _ in STATES.values() for m in ms}


def _money(name: str) -> Column:
    return F.when(F.col("amounts") > 0, units_to_double(F.col("cents"))).alias(name)


def _average(name: str) -> Column:
    return half_up_ratio(F.col("cents"), F.col("amounts"), num_scale=100).alias(name)


def _rating(digits: int = 2) -> Column:
    return half_up_ratio(F.col("rating_units"), F.col("ratings"), digits, MILLIONTHS).alias("avg_rating")


def _time() -> Column:
    return half_up_ratio(F.col("minutes"), F.col("timed")).alias("avg_delivery_time")


def builders(states: dict[str, DataFrame], as_of=None) -> dict[str, Callable[[], DataFrame]]:
    """The twelve marts from the states, each as a builder (the rank marts run jobs
    while they are built), as ``marts.all_marts`` gives them."""
    def roll(name: str, *by: str) -> DataFrame:
        return _roll(states[name], *by)

    def renamed(name: str, to: str) -> Column:
        return F.col(name).alias(to)

    customer = ("customer_id", "customer_name", "city", "loyalty_tier")
    place = ("restaurant_id", "restaurant_name", "cuisine_type", "delivery_city")
    partner = ("delivery_partner_id", "partner_name", "vehicle_type")

    def by_day() -> DataFrame:
        # days of a customer without orders left do not count
        return roll("customer", "order_date", *customer)

    def of_customers(*by: str) -> DataFrame:
        return by_day().groupBy(*by).agg(
            F.max("order_date").alias("last_order_date"), *[F.sum(c).alias(c) for c in ("orders", "cents", "amounts")])

    def city() -> DataFrame:
        people = roll("city_customer", "delivery_city", "customer_id").groupBy(
            F.col("delivery_city").alias("_city")).agg(F.count("customer_id").alias("customers"))
        rows = roll("city", "delivery_city")
        return rows.join(people, rows["delivery_city"].eqNullSafe(people["_city"]), "left").select(
            "delivery_city", renamed("orders", "total_orders"), "customers", _money("total_revenue"), _average("avg_order_value"))

    def months() -> DataFrame:
        return by_day().select(month_label("order_date").alias("order_month"), "customer_id")

    def trends() -> DataFrame:
        rows = roll("totals", "order_date").groupBy(month_label("order_date").alias("order_month")).agg(
            F.sum("orders").alias("orders"), F.sum("cents").alias("_cents"))
        people = months().distinct().groupBy(F.col("order_month").alias("_m")).agg(F.count("customer_id").alias("customers"))
        return M.month_growth(rows.join(people, F.col("order_month").eqNullSafe(F.col("_m")), "left").drop("_m"))

    return {
        "gold_order_summary": lambda: _summary(states, by_day()),
        "gold_revenue_city": city,
        "gold_restaurant_performance": lambda: M.restaurant_ranks(roll("restaurant", *place).select(
            *place, renamed("orders", "total_orders"), _money("total_revenue"), _rating(), _time())),
        "gold_customer_rfm": lambda: M.rfm_scores(of_customers(*customer).select(
            *customer, "last_order_date", renamed("orders", "frequency"), _money("monetary")), as_of),
        "gold_top_customers": lambda: M.top_spenders(of_customers(*customer[:3]).select(
            *customer[:3], _money("total_spend"), renamed("orders", "total_orders"))),
        "gold_partner_performance": lambda: roll("partner", *partner).select(
            *partner, renamed("orders", "deliveries"), _time(), _rating()).withColumn(
            "performance_tier", M.partner_tier(F.col("avg_rating"), F.col("avg_delivery_time"))),
        "gold_payment_analysis": lambda: roll("payment", "payment_method").select(
            "payment_method", "orders", _money("revenue"), _average("avg_order_value")),
        "gold_peak_hours": lambda: roll("hour", "order_hour").select("order_hour", "orders", _money("revenue")),
        "gold_monthly_trends": trends,
        "gold_delivery_analysis": lambda: roll("delivery", "delivery_city", "vehicle_type").select(
            "delivery_city", "vehicle_type", _time(), *[renamed(b, f"{b}_deliveries") for b in BANDS]),
        "gold_customer_retention": lambda: months().groupBy("customer_id").agg(
            F.countDistinct("order_month").alias("active_months")),
        "gold_cuisine_performance": lambda: roll("cuisine", "cuisine_type").select(
            "cuisine_type", "orders", _money("revenue"), _rating(1)),
    }


def marts(states: dict[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    return {n: b() for n, b in builders(states, as_of).items()}


def _summary(s: dict[str, DataFrame], customers: DataFrame) -> DataFrame:
    """One row, also without any state: totals beside three distinct counts."""
    totals = _roll(s["totals"], "order_date").agg(*[F.sum(c).alias(c) for c in ("orders", "cents", "amounts", "delivered", "cancelled")])
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    rows = totals.select(
        zero(F.col("orders")).alias("total_orders"), _money("total_revenue"), _average("avg_order_value"),
        zero(F.col("delivered")).alias("delivered_orders"), zero(F.col("cancelled")).alias("cancelled_orders"))
    ids = {"total_customers": (customers, "customer_id"),
           "total_restaurants": (_roll(s["restaurant"], "restaurant_id"), "restaurant_id"),
           "total_partners": (_roll(s["partner_ids"], "delivery_partner_id"), "delivery_partner_id")}
    for name, (df, key) in ids.items():
        rows = rows.unionByName(df.select(key).distinct().agg(F.count(key).alias(name)), allowMissingColumns=True)
    rows = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    return M.with_rates(rows.select("total_orders", *ids, "total_revenue", "avg_order_value", "delivered_orders", "cancelled_orders"))


class MartStates:
    """Stored states below a folder. ``buckets_from``: bytes of a batch from which its
    states are bucketed; batches of one store may differ in it."""

    def __init__(self, spark: SparkSession, folder: str, buckets_from: int = BUCKETS_FROM) -> None:
        self.spark, self.folder, self.buckets_from = spark, folder.rstrip("/"), buckets_from

    def _commits(self) -> list[dict]:
        return [json.loads(t) for _, t in manifests.read_text(self.spark, self.folder, BATCH)]

    def _commit(self, states: dict[str, DataFrame], commits: list[dict], replaces: bool, buckets: int) -> None:
        """``buckets`` 0: plain files."""
        number, tag = len(commits), uuid.uuid4().hex[:12]
        dealt = {n: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in states[n].schema) for n in MANY_GROUPS if buckets}

        def write(name: str) -> None:
            part, how = f"{number:06d}-{tag}", {"compression": "zstd"}
            if name in dealt:
                writers.write_bucketed(states[name], f"{self._dealt(name, buckets)}/{part}", STATES[name][0], buckets, how)
            else:
                writers.write_overwrite(states[name], f"{self.folder}/{name}/{part}", options=how)

        with ThreadPoolExecutor(max_workers=4) as pool:  # independent small jobs
            for job in [pool.submit(copy_context().run, write, name) for name in states]:
                job.result()
        made = manifests.write_once(self.spark, f"{self.folder}/{BATCH}{number:06d}", json.dumps(
            {"part": f"{number:06d}-{tag}", "replaces": replaces, "buckets": buckets, "dealt": dealt}))
        if not made:
            raise RuntimeError(f"{self.folder}: another writer has added batch {number}")

    def _dealt(self, name: str, buckets: int) -> str:
        return f"{self.folder}/{name}-in-{buckets}"

    def add(self, silver: DataFrame, sign: int = 1) -> None:
        """Add the states of a batch of silver rows (or take them back)."""
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions", "200")) if estimated_bytes(silver) >= self.buckets_from else 0
        self._commit(build(silver, sign), self._commits(), False, buckets)

    def _present(self) -> list[dict]:
        """The commits since the last compaction."""
        commits = self._commits()
        if not commits:
            raise FileNotFoundError(f"{self.folder}: no states")
        return commits[max((i for i, c in enumerate(commits) if c["replaces"]), default=0):]

    def states(self) -> dict[str, DataFrame]:
        """All states since the last compaction, not summed yet."""
        commits, out = self._present(), {}
        for n, (keys, _, _) in STATES.items():
            plain, dealt = [], {}  # one scan for all parts of a number of buckets
            for c in commits:
                if n in c.get("dealt", {}):
                    dealt.setdefault(c["buckets"], []).append((c["part"], c["dealt"][n]))
                else:
                    plain.append(c["part"])
            parts = [self.spark.read.parquet(*[f"{self.folder}/{n}/{p}" for p in plain])] if plain else []
            parts += [writers.read_bucketed(self.spark, self._dealt(n, k), [p for p, _ in some], some[0][1], keys, k)
                      for k, some in dealt.items()]
            out[n] = reduce(DataFrame.unionByName, parts)
        return out

    def builders(self, as_of=None) -> dict[str, Callable[[], DataFrame]]:
        """For ``releases.publish_release``."""
        return builders(self.states(), as_of)

    def marts(self, as_of=None) -> dict[str, DataFrame]:
        return marts(self.states(), as_of)

    def compact(self) -> None:
        """Replace all batches by their sum. Sums of both signs stay signed, so a
        later batch can still take rows back."""
        summed = {n: df.groupBy(*STATES[n][0]).agg(*[F.sum(c).alias(c) for c in df.columns if c in _MEASURES]).filter("n_rows <> 0")
                  for n, df in self.states().items()}
        self._commit(summed, self._commits(), True, max(c.get("buckets", 0) for c in self._present()))
