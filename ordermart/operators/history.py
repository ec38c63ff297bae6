"""Per-customer order history: order number, previous amount, running revenue.

Semantics (kept from the pipeline):

* ``customer_order_number`` = ``row_number()`` per customer ordered by
  (order_date, order_id) — the order id breaks same-day ties deterministically;
* ``previous_order_amount`` = ``lag(final_amount)`` over the same order;
* ``running_customer_revenue`` = running sum with the default RANGE frame over
  ``order_date`` ALONE, so all same-day orders share the day's closing total.

``customer_history`` (default) never puts one customer into one task. The key
(customer, date, order_id) is cut into buckets, runs of the stored order
(``ranks.with_buckets``); windows run per (bucket, customer); a small summary
per (bucket, customer) — row count, cents, last amount — is prefix-summed over
buckets and joined back on the same keys the fact is already partitioned by.
Same-day orders that straddle a bucket boundary are added back through a
(bucket, customer, day) aggregate. The fact is shuffled once.

``customer_history_hybrid`` (the default of the silver build) counts rows per
customer first (one partial aggregate) and sends only customers above
``heavy_rows`` through the bucketed path; every other customer takes the plain
window, whose groups are then bounded by ``heavy_rows``.

``customer_history_window`` is the plain one-window form (one customer = one
task); it is kept as the reference implementation for tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import units, units_to_double
from .ranks import with_buckets

OUT_COLS = ["customer_order_number", "previous_order_amount", "running_customer_revenue"]


def customer_history_window(df: DataFrame, cust: str = "customer_id", date: str = "order_date",
                            oid: str = "order_id", amount: str = "final_amount") -> DataFrame:
    ordered = Window.partitionBy(cust).orderBy(date, oid)
    by_day = (Window.partitionBy(cust).orderBy(date)
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({
        "customer_order_number": F.row_number().over(ordered),
        "previous_order_amount": F.lag(amount).over(ordered),
        "running_customer_revenue": units_to_double(F.sum(units(amount)).over(by_day)),
    })


def _ns_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Null-safe equi-join on ``keys`` keeping the left key columns."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond: Column | None = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def customer_history(df: DataFrame, cust: str = "customer_id", date: str = "order_date",
                     oid: str = "order_id", amount: str = "final_amount",
                     buckets: int | None = None) -> DataFrame:
    order = [(cust, False), (date, False), (oid, False)]
    # stored: read by the local windows, the segment summary and the day summary
    b = with_buckets(df.withColumn("_c", units(amount)), order, buckets=buckets, name="history-buckets")
    seg_keys = ["_bkt", cust]

    ordered = Window.partitionBy(*seg_keys).orderBy(date, oid)
    by_day = (Window.partitionBy(*seg_keys).orderBy(date)
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    local = b.withColumns({
        "_lrn": F.row_number().over(ordered),
        "_llag": F.lag(amount).over(ordered),
        "_lrun": F.sum("_c").over(by_day),
        "_lcn": F.count("_c").over(by_day),
    })

    # one row per (bucket, customer): small compared with the fact
    seg = b.groupBy(*seg_keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("_c").alias("_s"),
        F.count("_c").alias("_sc"),
        F.max_by(F.col(amount), F.struct(date, oid)).alias("_last"),
        F.max(date).alias("_last_date"),
    )
    # same-day cents in LATER buckets, needed at each segment's last day
    day = b.groupBy("_bkt", cust, date).agg(F.sum("_c").alias("_ds"), F.count("_c").alias("_dc"))
    later = (Window.partitionBy(cust, date).orderBy("_bkt")
             .rowsBetween(1, Window.unboundedFollowing))
    day = day.select("_bkt", cust, F.col(date).alias("_last_date"),
                     F.coalesce(F.sum("_ds").over(later), F.lit(0)).alias("_spill"),
                     F.coalesce(F.sum("_dc").over(later), F.lit(0)).alias("_spill_n"))
    seg = _ns_join(seg, day, ["_bkt", cust, "_last_date"])
    before = Window.partitionBy(cust).orderBy("_bkt")
    prior = before.rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.select(
        *seg_keys, "_last_date", "_spill", "_spill_n",
        F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_prior_n"),
        F.coalesce(F.sum("_s").over(prior), F.lit(0)).alias("_prior_s"),
        F.coalesce(F.sum("_sc").over(prior), F.lit(0)).alias("_prior_c"),
        F.lag("_last").over(before).alias("_prev_last"),
    )

    out = _ns_join(local, seg, seg_keys)
    at_last = F.col(date).eqNullSafe(F.col("_last_date"))
    spill = F.when(at_last, F.col("_spill")).otherwise(F.lit(0))
    spill_n = F.when(at_last, F.col("_spill_n")).otherwise(F.lit(0))
    # SUM over a frame is NULL only when the frame has no non-NULL value
    seen = F.col("_prior_c") + F.col("_lcn") + spill_n
    run = F.when(seen > 0, F.col("_prior_s") + F.coalesce(F.col("_lrun"), F.lit(0)) + spill)
    return out.withColumns({
        "customer_order_number": (F.col("_prior_n") + F.col("_lrn")).cast("int"),
        "previous_order_amount": F.when(F.col("_lrn") == 1, F.col("_prev_last"))
        .otherwise(F.col("_llag")),
        "running_customer_revenue": units_to_double(run),
    }).drop("_bkt", "_c", "_lrn", "_llag", "_lrun", "_lcn", "_last_date", "_spill",
            "_spill_n", "_prior_n", "_prior_s", "_prior_c", "_prev_last")


HEAVY_ROWS = 1_000_000
MAX_HEAVY_KEYS = 10_000


def heavy_keys(df: DataFrame, key: str, heavy_rows: int,
               max_keys: int = MAX_HEAVY_KEYS) -> list | None:
    """Keys with more than ``heavy_rows`` rows (map-side pre-aggregated count).

    There are at most rows / heavy_rows of them; ``None`` when more than
    ``max_keys`` exist (the caller then treats every key as heavy).
    """
    rows = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > heavy_rows).select(key).limit(max_keys + 1).collect())
    if len(rows) > max_keys:
        return None
    return [r[0] for r in rows]


def customer_history_hybrid(df: DataFrame, cust: str = "customer_id", date: str = "order_date",
                            oid: str = "order_id", amount: str = "final_amount",
                            heavy_rows: int = HEAVY_ROWS, buckets: int | None = None) -> DataFrame:
    """Plain window for ordinary customers, bucketed path for heavy ones.

    With no more rows in total than ``heavy_rows`` no customer can be heavy,
    and the per-customer count job is skipped (on staged parquet the total
    comes from file metadata).
    """
    heavy = [] if df.count() <= heavy_rows else heavy_keys(df, cust, heavy_rows)
    kw = dict(cust=cust, date=date, oid=oid, amount=amount)
    if heavy is None:
        return customer_history(df, buckets=buckets, **kw)
    if not heavy:
        return customer_history_window(df, **kw)
    # the split must be a true/false test for every row: x IN (..., NULL) is not
    named = [k for k in heavy if k is not None]
    is_heavy = F.coalesce(F.col(cust).isin(named), F.lit(False))
    if len(named) < len(heavy):  # orders without a customer are many: split them too
        is_heavy = is_heavy | F.col(cust).isNull()
    light = customer_history_window(df.filter(~is_heavy), **kw)
    hot = customer_history(df.filter(is_heavy), buckets=buckets, **kw)
    return light.unionByName(hot)
