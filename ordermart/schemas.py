"""Explicit schemas for the raw (CSV) inputs and the column sets of each layer.

Raw CSVs are read with these schemas instead of ``inferSchema`` (which costs a
full extra pass over the input). Ids are ``long`` so the same code serves the
driver's tables (BIGINT keys) and 32-bit CSV ids alike.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


ORDERS_RAW = _s(
    ("order_id", LongType()), ("customer_id", LongType()), ("restaurant_id", LongType()),
    ("delivery_partner_id", LongType()), ("order_date", DateType()),
    ("order_timestamp", TimestampNTZType()), ("delivery_city", StringType()),
    ("payment_method", StringType()), ("order_status", StringType()),
    ("delivery_time_minutes", IntegerType()), ("order_amount", DoubleType()),
    ("tip_amount", DoubleType()), ("discount_amount", DoubleType()),
    ("final_amount", DoubleType()), ("rating", DoubleType()),
)

CUSTOMERS_RAW = _s(
    ("customer_id", LongType()), ("customer_name", StringType()), ("gender", StringType()),
    ("age", IntegerType()), ("city", StringType()), ("signup_date", DateType()),
    ("loyalty_tier", StringType()),
)

RESTAURANTS_RAW = _s(
    ("restaurant_id", LongType()), ("restaurant_name", StringType()),
    ("cuisine_type", StringType()), ("city", StringType()),
    ("avg_preparation_time", IntegerType()), ("restaurant_rating", DoubleType()),
)

PARTNERS_RAW = _s(
    ("delivery_partner_id", LongType()), ("partner_name", StringType()),
    ("vehicle_type", StringType()), ("joining_date", DateType()), ("city", StringType()),
)

# Whole record of a raw row with a value that could not be parsed.
CORRUPT_COL = "_corrupt_record"
# Folder name of an empty string (a folder name can not be empty).
EMPTY_PARTITION = "__EMPTY__"

RAW_SCHEMAS = {
    "orders": ORDERS_RAW,
    "customers": CUSTOMERS_RAW,
    "restaurants": RESTAURANTS_RAW,
    "partners": PARTNERS_RAW,
}

# Dimension columns carried into silver by each enrichment join (key first).
CUSTOMER_DIM_COLS = ["customer_id", "customer_name", "gender", "age", "city",
                     "signup_date", "loyalty_tier"]
RESTAURANT_DIM_COLS = ["restaurant_id", "restaurant_name", "cuisine_type",
                       "avg_preparation_time"]
PARTNER_DIM_COLS = ["delivery_partner_id", "partner_name", "vehicle_type", "joining_date"]
