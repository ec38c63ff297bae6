"""Star-schema views over the driver's TPC-H-like tables.

The pipeline consumes four raw inputs (orders fact + customers, restaurants
and partners dimensions). The test tables have no delivery schema, so these
views derive one deterministically:

* fact grain = one ``lineitem`` row; ``order_id`` is deliberately not unique
  (``l_orderkey * 10 + l_linenumber`` collides), so dedup has real work;
* ``tb1..tb4`` carry a total order inside each ``order_id`` for dedup;
* delivery city is padded lower case so city normalisation has real work;
* some orders have no customer, restaurant or partner (NULL keys), and some
  keys have no dimension row (orphans), each by a fixed rule on the key;
* ratings have two decimals.

Everything is a lazy DataFrame: Catalyst prunes the unused columns of each
scan and pushes the join keys' filters down to parquet.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TIEBREAK_COLS = ["tb1", "tb2", "tb3", "tb4"]


@dataclass(frozen=True)
class StarSchema:
    orders: DataFrame
    customers: DataFrame
    restaurants: DataFrame
    partners: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {"orders": self.orders, "customers": self.customers,
                "restaurants": self.restaurants, "partners": self.partners}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def orders_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # the city of an order first: a customer table beyond the broadcast threshold
    # then shuffles the orders, not their several times larger lines
    placed = (o.join(c, o.o_custkey == c.c_custkey)
              .join(n, c.c_nationkey == n.n_nationkey)
              .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "n_name"))
    j = li.join(placed, li.l_orderkey == placed.o_orderkey)
    status = (F.when(F.col("o_orderstatus") == "F", "DELIVERED")
              .when(F.col("o_orderstatus") == "O", "CANCELLED")
              .when(F.col("l_returnflag") == "R", "RETURNED")
              .otherwise("PARTIAL"))
    amount_cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        F.when(F.col("l_orderkey") % 19 != 0, F.col("o_custkey")).alias("customer_id"),
        F.when(F.col("l_partkey") % 23 != 0, F.col("l_suppkey")).alias("restaurant_id"),
        F.when(F.col("l_suppkey") % 29 != 0, F.col("l_partkey")).alias("delivery_partner_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        # wall-clock timestamps whatever the reader's timestamp inference
        F.timestamp_add("HOUR", (F.col("l_partkey") % 24).cast("int"),
                        F.col("o_orderdate")).cast("timestamp_ntz").alias("order_timestamp"),
        F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("delivery_city"),
        F.col("o_orderpriority").alias("payment_method"),
        status.alias("order_status"),
        (F.abs(F.datediff(F.col("l_shipdate"), F.col("o_orderdate"))) % 200)
        .cast("int").alias("delivery_time_minutes"),
        ((amount_cents % 200000 - 5000).cast("double") / 100).alias("order_amount"),
        F.when(F.col("l_tax") == 0, F.lit(None))
        .otherwise(F.round(F.col("l_tax") * 1000)).cast("double").alias("tip_amount"),
        F.when(F.col("l_discount") == 0, F.lit(None))
        .otherwise(F.round(F.col("l_discount") * 3000)).cast("double").alias("discount_amount"),
        F.when(F.col("l_quantity") < 4, F.lit(None))
        .otherwise(F.round(F.col("l_quantity") / F.lit(9.0), 2)).cast("double").alias("rating"),
        F.col("l_partkey").alias("tb1"), F.col("l_suppkey").alias("tb2"),
        F.col("l_extendedprice").alias("tb3"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("tb4"),
    )


def customers_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey).filter(F.col("c_custkey") % 13 != 5).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        (F.lit(18) + F.col("c_custkey") % 43).cast("int").alias("age"),
        F.col("n_name").alias("city"),
        F.date_add(F.lit("1994-01-01").cast("date"),
                   (F.col("c_custkey") % 365).cast("int")).alias("signup_date"),
        F.col("c_mktsegment").alias("loyalty_tier"),
    )


def restaurants_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey).filter(F.col("s_suppkey") % 11 != 3)
            .select(
                F.col("s_suppkey").alias("restaurant_id"),
                F.col("s_name").alias("restaurant_name"),
                F.col("r_name").alias("cuisine_type"),
                F.col("n_name").alias("city"),
                (F.lit(10) + F.col("s_suppkey") % 36).cast("int").alias("avg_preparation_time"),
                ((F.lit(10) + F.col("s_suppkey") % 41).cast("double") / 10).alias("restaurant_rating"),
            ))


def partners_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.filter(F.col("p_partkey") % 17 != 4).select(
        F.col("p_partkey").alias("delivery_partner_id"),
        F.col("p_name").alias("partner_name"),
        F.col("p_type").alias("vehicle_type"),
        F.date_add(F.lit("1992-01-01").cast("date"),
                   (F.col("p_partkey") % 1000).cast("int")).alias("joining_date"),
        F.col("p_brand").alias("city"),
    )


def star_schema(spark: SparkSession, sf_dir: str) -> StarSchema:
    return StarSchema(
        orders=orders_fact(spark, sf_dir),
        customers=customers_dim(spark, sf_dir),
        restaurants=restaurants_dim(spark, sf_dir),
        partners=partners_dim(spark, sf_dir),
    )
