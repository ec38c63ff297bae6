"""Faults found in review, each with the input that showed it."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import ROOT, rows
from fixtures import D, order, orders_df
from ordermart import rules
from ordermart.operators import history as H
from ordermart.operators import marts as M
from ordermart.operators import quality as Q
from ordermart.operators import ranks as R
from ordermart.operators import silver as S
from ordermart.plans import pipeline
from ordermart.schemas import CORRUPT_COL, ORDERS_RAW
from ordermart.session import scratch_path
from ordermart.sinks import writers
from ordermart.sources import raw


@pytest.mark.parametrize("heavy_rows", [90, 10**6])
def test_null_customers_above_and_below_the_heavy_bound(spark, heavy_rows):
    data = [order(order_id=i, customer_id=None if i < 100 else 7 if i < 200 else i % 20 + 10,
                  order_date=D(2024, 1, 1 + i % 28), order_amount=100.0 + i) for i in range(400)]
    df = S.clean(orders_df(spark, *data))
    cols = ["order_id", "customer_id", *H.OUT_COLS]
    got = H.customer_history_hybrid(df, heavy_rows=heavy_rows, buckets=9)
    assert got.count() == 400
    assert rows(got, cols) == rows(H.customer_history_window(df), cols)


def test_descending_ranks_agree_on_nan_dates_and_text(spark):
    g = spark.createDataFrame(
        [(i, v, dt.date(2024, 1, 1 + i) if i % 4 else None, t) for i, (v, t) in enumerate([
            (float("nan"), "a"), (2.5, "ab"), (None, None), (-1.0, ""), (float("inf"), "b"), (2.5, "abc"),
            (float("nan"), "ä"), (0.0, "z"), (-7.25, "a"), (3.0, "aa")])], "k long, v double, d date, t string")
    for col in ("v", "d", "t"):
        order = [(col, True), ("k", False)]
        plain = R.global_row_number(g, order, "r")
        assert rows(R.global_row_number(g, order, "r", buckets=5, small_rows=0), ["k", "r"]) == rows(plain, ["k", "r"])
        assert rows(R.global_dense_rank(g, col, True, "r", buckets=5, small_rows=0), ["k", "r"]) == rows(
            R.global_dense_rank(g, col, True, "r"), ["k", "r"])


def test_bucket_expression_does_not_grow_code(spark):
    df = spark.range(20000).select((F.col("id") * 7919 % 20011).alias("k"))
    few, many = (R.with_buckets(df, [("k", False)], buckets=b) for b in (64, 4096))
    assert many.select("_bkt").distinct().count() > 3000
    # each bucket is a run of the order
    spans = many.groupBy("_bkt").agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("_bkt").collect()
    assert all(x.b < y.a for x, y in zip(spans, spans[1:]))
    assert few.select("_bkt").distinct().count() == 64


def test_two_decimal_ratings_keep_their_digits(spark):
    df = S.clean(orders_df(spark, *[order(order_id=i, rating=4.24) for i in range(3)]))
    silver = df.withColumns({"restaurant_name": F.lit("r"), "cuisine_type": F.lit("c")})
    assert M.restaurant_performance(silver).first().avg_rating == 4.24


def test_malformed_records_go_to_quarantine(spark):
    path = scratch_path(spark, "t-malformed")
    names = [f.name for f in ORDERS_RAW.fields]
    good = {"order_id": "1", "customer_id": "2", "order_date": "2024-01-01", "order_amount": "500.0",
            "order_status": "DELIVERED", "delivery_time_minutes": "20", "delivery_city": "x"}
    bad = [good, good | {"order_id": "2", "order_amount": "1,500.0"}, good | {"order_id": "3", "order_date": "soon"},
           good | {"order_id": "x"}, good | {"order_id": "y"}, good]
    text = spark.createDataFrame([[r.get(n) for n in names] for r in bad], ", ".join(f"{n} string" for n in names))
    writers.write_raw_csv(text, path)
    back = raw.read_csv(spark, path, "orders", corrupt=True)
    flagged = S.flagged_orders(back.cache())
    clean, quarantine = Q.split(flagged)
    assert clean.count() == 1 and CORRUPT_COL not in clean.columns  # the repeated good row is merged
    q = quarantine.collect()
    assert len(q) == 4 and all(r.dq_flag == rules.MALFORMED_FLAG and r[CORRUPT_COL] for r in q)
    assert dict(Q.summary(flagged).collect())["MALFORMED"] == 4


def test_failing_publish_keeps_the_old_version(spark):
    writers.ensure_database(spark, "ordermart_fault", scratch_path(spark, "t-fault-db"))
    root = scratch_path(spark, "t-fault")
    writers.publish({"t": spark.range(3).toDF("a")}, root, "ordermart_fault")
    first = writers.current_path(spark, os.path.join(root, "t"))
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("a"))
    with pytest.raises(Exception):  # noqa: B017
        writers.publish({"t": broken}, root, "ordermart_fault")
    assert spark.table("ordermart_fault.t").count() == 3
    assert writers.current_path(spark, os.path.join(root, "t")) == first
    for n in (4, 5, 6):
        writers.publish({"t": spark.range(n).toDF("a")}, root, "ordermart_fault")
        assert spark.table("ordermart_fault.t").count() == n
    writers.publish({"t": spark.range(2).toDF("other")}, root, "ordermart_fault")
    assert spark.table("ordermart_fault.t").columns == ["other"]
    kept = [d for d in os.listdir(os.path.join(root, "t")) if d.startswith("v-")]
    assert len(kept) == writers.KEEP_VERSIONS
    assert raw.read_path(spark, writers.current_path(spark, os.path.join(root, "t"))).count() == 2


def test_partition_values_stay_text(spark):
    df = spark.createDataFrame([(1, "007"), (2, "12"), (3, ""), (4, None), (5, "x")], "id long, city string")
    path = writers.write_partitioned(df, scratch_path(spark, "t-typed"), ["city"])
    assert rows(raw.read_path(spark, path, text_partitions=["city"]), ["id", "city"]) == rows(df)
    digits = df.filter("id < 3")  # folders that all look like numbers
    path = writers.write_partitioned(digits, scratch_path(spark, "t-typed"), ["city"])
    assert rows(raw.read_path(spark, path, text_partitions=["city"]), ["id", "city"]) == rows(digits)


def test_order_summary_has_no_expand(spark):
    df = S.clean(orders_df(spark, order(order_id=1), order(order_id=2, customer_id=None)))
    out = M.order_summary(df)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.first().total_customers == 1 and M.order_summary(df.limit(0)).first().total_orders == 0


def test_broadcast_bound_is_in_bytes(spark):
    d = spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "customer_id long, customer_name string")
    assert 50_000 < S.data_bytes(d) < 60_000
    hinted = lambda bound: "ResolvedHint" in S._dim(
        d, d.columns, bound)._jdf.queryExecution().analyzed().toString()
    assert hinted(True) and hinted(60_000) and not hinted(10_000)


STOCK = """
import sys; sys.path[:0] = [{root!r}, {root!r} + "/tests"]
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "4").getOrCreate()
assert not spark.conf.get("spark.checkpoint.dir", None)
import os
from ordermart.plans import pipeline
from ordermart.session import staging
from test_io_pipeline import _land
target = {target!r}
_, paths, _ = _land(spark, target)
out = pipeline.run(spark, paths, target + "/out", as_of="2001-08-02", now="2001-08-02 00:00:00")
assert dict(out["manifest"].collect())["silver_orders"] > 0
left = lambda: os.listdir(target + "/out/_staging")
assert left() == []
try:
    pipeline.run(spark, paths, target + "/out", as_of="not a date")
except Exception:
    assert left() == []
    print("DONE")
"""


def test_pipeline_on_a_stock_session(tmp_path):
    (tmp_path / "conf").mkdir()
    env = {k: v for k, v in os.environ.items() if k not in ("SPARK_CONF_DIR", "PYSPARK_SUBMIT_ARGS")}
    done = subprocess.run([sys.executable, "-c", STOCK.format(root=ROOT, target=str(tmp_path / "t"))],
                          env=env | {"SPARK_CONF_DIR": str(tmp_path / "conf")}, cwd=tmp_path,
                          capture_output=True, text=True, timeout=600)
    assert "DONE" in done.stdout, done.stderr[-3000:]


def test_registered_layers_of_a_run(spark):
    from test_io_pipeline import _land
    root = scratch_path(spark, "t-layers")
    _, paths, _ = _land(spark, root)
    pipeline.run(spark, paths, os.path.join(root, "out"), as_of="2001-08-02", database="ordermart_layers")
    names = {r.tableName for r in writers.list_tables(spark, "ordermart_layers").collect()}
    assert {"bronze_orders", "bronze_customers", "silver_orders", "quarantine_orders", "gold_customer_rfm"} <= names
    assert spark.sql("SELECT count(*) FROM ordermart_layers.silver_orders").first()[0] > 0
