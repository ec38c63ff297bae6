"""Customer activity by month as bit sets: one row a customer, from which
retention and every cohort follow.

A month is a bit of 64-month words; a customer's words are OR-ed together by a
map-side partial aggregate, so the fact is shuffled once, as at most one row a
customer and map task, and a customer with millions of orders stays a few longs.
Bit sets of several periods merge by OR (``merge``), so new days are added
without reading old ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_label

WORD = 64
EPOCH = "1970-01-01"


def month_index(date: str | Column) -> Column:
    """Months since January 1970 (negative before)."""
    c = F.col(date) if isinstance(date, str) else date
    return (F.year(c) - 1970) * 12 + F.month(c) - 1


def month_date(index: Column) -> Column:
    return F.add_months(F.lit(EPOCH).cast("date"), index)


def _word(index: Column) -> Column:
    return F.floor(index / F.lit(WORD)).cast("int")


def activity(orders: DataFrame, cust: str = "customer_id", date: str = "order_date") -> DataFrame:
    """(customer, months: word -> bits, undated): active months of each customer;
    ``undated``: whether an order has no date. The words are found by one minimum
    and maximum over the dates (statistics of a stored table)."""
    low, high = orders.agg(F.min(month_index(date)), F.max(month_index(date))).first()
    words = [] if low is None else range(low // WORD, high // WORD + 1)
    index = month_index(date)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(index, F.lit(WORD)).cast("int"))
    sets = [F.bit_or(F.when(_word(index) == w, bit)).alias(f"w{w}") for w in words]
    rows = orders.groupBy(cust).agg(*sets, F.max(F.col(date).isNull()).alias("undated"))
    pairs = [F.struct(F.lit(w).alias("word"), F.col(f"`w{w}`").alias("bits")) for w in words]
    empty = F.array().cast("array<struct<word:int,bits:bigint>>")
    months = F.filter(F.array(*pairs), lambda p: p["bits"].isNotNull()) if pairs else empty
    return rows.select(cust, months.alias("months"), "undated")


def merge(parts: DataFrame, cust: str = "customer_id") -> DataFrame:
    """One row a customer from the activity of several periods."""
    flat = parts.select(cust, "undated", F.explode_outer("months").alias("m")).select(cust, "undated", "m.word", "m.bits")
    by_word = flat.groupBy(cust, "word").agg(F.bit_or("bits").alias("bits"), F.max("undated").alias("undated"))
    return by_word.groupBy(cust).agg(
        F.sort_array(F.collect_list(F.when(F.col("word").isNotNull(), F.struct("word", "bits")))).alias("months"),
        F.max("undated").alias("undated"))


def active_months(rows: DataFrame, cust: str = "customer_id") -> DataFrame:
    """KPI 11 from the bit sets: distinct active months per customer."""
    counted = F.aggregate("months", F.lit(0).cast("long"), lambda n, m: n + F.bit_count(m["bits"]))
    return rows.select(cust, counted.alias("active_months"))


def cohorts(rows: DataFrame) -> DataFrame:
    """(cohort_month, month_offset, customers) from the bit sets: customers per
    first month and months since. Customers without any dated order form the NULL
    cohort; an undated order counts in the NULL offset."""
    bits = F.sequence(F.lit(0), F.lit(WORD - 1))
    each = F.flatten(F.transform("months", lambda m: F.transform(
        F.filter(bits, lambda b: F.getbit(m["bits"], b) == 1), lambda b: m["word"] * WORD + b)))
    # the flag of undated orders is one month more, without a number
    each = F.concat(each, F.when(F.col("undated"), F.array(F.lit(None).cast("int"))).otherwise(F.array().cast("array<int>")))
    first = F.array_min("all")
    one = (rows.select(each.alias("all")).select(first.alias("first"), F.explode("all").alias("at"))
           .groupBy("first", (F.col("at") - F.col("first")).cast("int").alias("month_offset")).agg(F.count(F.lit(1)).alias("customers")))
    return one.select(month_label(month_date(F.col("first"))).alias("cohort_month"), "month_offset", "customers")
