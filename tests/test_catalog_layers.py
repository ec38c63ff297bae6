"""What the queries' layers stage: no more columns and rows than are read, and no step twice."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fixtures import TS, dims, order, orders_df
from ordermart.operators import marts as M
from ordermart.operators import quality as Q
from ordermart.operators import silver as S
from ordermart.operators.history import customer_history_window
from ordermart.plans import catalog, pipeline
from ordermart.plans.catalog import Ctx
from ordermart.sources.adapter import TIEBREAK_COLS, StarSchema


@pytest.fixture()
def star(spark):
    made = [order(order_id=i % 50, customer_id=(1, 2, 4, None)[i % 4], restaurant_id=(1, 3)[i % 2], delivery_partner_id=1 + i % 3,
                  order_timestamp=TS(2024, 6, 3, i % 24, 0), order_amount=float(100 + i), rating=(4.0, None, 9.0)[i % 3])
            for i in range(120)]
    orders = orders_df(spark, *made).withColumns({c: F.col("order_amount") for c in TIEBREAK_COLS})
    return StarSchema(orders, *dims(spark))


def ctx(spark, star):
    c = Ctx(spark, "")
    c.star = star
    return c


def test_mart_silver_is_the_silver_without_unread_columns(spark, star):
    c = ctx(spark, star)
    got, want = c.mart_silver, c.silver
    assert got.columns == [x for x in want.columns if x in M.MART_COLS] and set(got.columns) == set(M.MART_COLS)
    assert rows(got) == rows(want.select(*got.columns)) and got.count()


def test_only_clean_rows_of_read_columns_are_staged(spark, star, monkeypatch):
    staged = []
    monkeypatch.setattr(S, "materialize", lambda df, name, fmt="parquet": staged.append((name, df)) or df)
    parts = S.build_silver_parts(star.orders, star.customers, star.restaurants, star.partners, now="2024-07-01 00:00:00",
                                 order_by=TIEBREAK_COLS, drop=TIEBREAK_COLS, columns=("order_id", "customer_name", "is_weekend"))
    (name, df), = staged
    assert name == "clean-orders" and "tip_amount" not in df.columns and "payment_method" not in df.columns
    assert df.count() == parts["silver"].count() and parts["quarantine"].count()
    assert set(parts["silver"].columns) == {"order_id", "customer_name", "is_weekend"}


def test_history_reads_the_deduplicated_rows_from_a_copy(spark, star, tmp_path):
    star.orders.write.parquet(str(tmp_path / "orders"))
    c = ctx(spark, StarSchema(spark.read.parquet(str(tmp_path / "orders")), star.customers, star.restaurants, star.partners))
    got = c.history
    assert not any(str(tmp_path) in f for f in got.inputFiles())
    assert rows(got) == rows(customer_history_window(c.clean), got.columns)


def listed(seq):
    return [seq.apply(i) for i in range(seq.size())]


def nodes(plan):
    return [plan, *[x for child in listed(plan.children()) for x in nodes(child)]]


def test_clean_rows_of_some_columns(spark):
    """As the whole clean rows: also where a bad copy of an id is the one that is kept."""
    made = [order(order_id=i % 120 if i % 41 else None, customer_id=(1, 2, None)[i % 3], order_amount=(100.0 + i, -5.0, None)[i % 7 % 3],
                  rating=(4.0, None, 9.0)[i % 11 % 3], order_status=("DELIVERED", "LOST", None)[i % 13 % 3], discount_amount=(None, 3.0)[i % 2],
                  delivery_city=(" pune ", None)[i % 5 // 4], delivery_time_minutes=(25, 500)[i % 17 // 16]) for i in range(200)]
    orders = orders_df(spark, *made).withColumns({"tb1": F.col("customer_id"), "tb2": F.col("order_date"), "tb3": F.col("order_id"),
                                                  "tb4": F.monotonically_increasing_id()})
    how = {"order_by": TIEBREAK_COLS, "drop": TIEBREAK_COLS}
    columns = ["order_id", "customer_id", "order_date", "delivery_city", "rating", "final_amount"]
    for policy in ("pass", "flag"):
        for raw in (orders, orders.withColumn("_corrupt_record", F.when(F.col("tb4") % 9 == 4, F.lit("x")))):
            whole = Q.split(S.flagged_orders(raw, policy, **how))
            assert whole[0].count() and whole[1].count()
            assert rows(S.clean_orders_of(raw, columns, policy, **how)) == rows(whole[0], columns)
    assert rows(S.clean_orders_of(orders.drop("tb4"), columns)) == rows(Q.split(S.flagged_orders(orders.drop("tb4")))[0], columns)


def test_dedup_moves_only_the_read_columns(spark, star):
    plan = S.clean_orders_of(star.orders, ["order_id", "customer_id", "final_amount"], order_by=TIEBREAK_COLS, drop=TIEBREAK_COLS)
    window = next(x for x in nodes(plan._jdf.queryExecution().optimizedPlan()) if x.nodeName() == "Window")
    moved = {a.name() for a in listed(window.child().output())}
    assert moved == {"order_id", "customer_id", "final_amount", "_ok", *[f"_by{i}" for i in range(4)]}


def test_joins_of_a_fact_without_history_keep_the_rows(spark, star):
    clean = Q.split(S.flagged_orders(star.orders, order_by=TIEBREAK_COLS, drop=TIEBREAK_COLS))[0]
    want = S.enrich(clean, star.customers, star.restaurants, star.partners)
    got = S.enrich(clean, star.customers, star.restaurants, star.partners, joins=S.HISTORY_UNREAD)
    assert set(got.columns) == set(want.columns) and rows(got, want.columns) == rows(want)


def test_publish_marts_stores_the_columns_that_are_read(spark, star, monkeypatch):
    stored, persist = [], pipeline.persist_silver
    monkeypatch.setattr(pipeline, "persist_silver", lambda df, path: stored.append(df.columns) or persist(df, path))
    got = catalog._publish(ctx(spark, star))
    assert [set(x) for x in stored] == [set(M.MART_COLS)]
    whole = ctx(spark, star).silver
    assert {r[0]: r[1] for r in got.collect()} == {n: b(whole).count() for n, b in catalog.MART_BUILDERS.items()}
