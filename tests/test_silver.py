from pyspark.sql import functions as F

from conftest import rows
from fixtures import D, dims, order, orders_df
from ordermart.operators import quality as Q
from ordermart.operators import silver as S


def test_dq_first_match_and_null_fallthrough(spark):
    df = orders_df(
        spark,
        order(order_id=1, order_amount=0.0),                      # INVALID_AMOUNT (boundary 0)
        order(order_id=2, order_amount=10.0, discount_amount=50.0),  # NEGATIVE_FINAL
        order(order_id=3, delivery_time_minutes=181),             # EXCESS (181)
        order(order_id=4, delivery_time_minutes=180),             # OK (180)
        order(order_id=5, rating=5.1),                            # INVALID_RATING
        order(order_id=6, rating=5.0),                            # OK (5.0)
        order(order_id=7, order_status="PENDING"),                # UNKNOWN_STATUS
        order(order_id=8, order_amount=-1.0, rating=9.0),         # two rules: first wins
        order(order_id=9, order_amount=None),                     # NULL falls through: OK
        order(order_id=10, order_status=None),                    # NULL status: OK
        order(order_id=11, delivery_time_minutes=None, rating=None),
    )
    flagged = Q.classify(S.clean(df))
    got = dict((r.order_id, r.dq_flag) for r in flagged.select("order_id", "dq_flag").collect())
    assert got == {1: "INVALID_AMOUNT", 2: "NEGATIVE_FINAL", 3: "EXCESS_DELIVERY_TIME",
                   4: "OK", 5: "INVALID_RATING", 6: "OK", 7: "UNKNOWN_STATUS",
                   8: "INVALID_AMOUNT", 9: "OK", 10: "OK", 11: "OK"}
    clean, quarantine = Q.split(flagged)
    assert "dq_flag" not in clean.columns and "dq_flag" in quarantine.columns
    # invariant: clean + quarantine = deduplicated input
    assert clean.count() + quarantine.count() == flagged.count()
    summ = dict(Q.summary(flagged).collect())
    assert summ["total_records"] == 11 and summ["valid_records"] == 5
    assert summ["quarantine_records"] == 6 and summ["INVALID_AMOUNT"] == 2


def test_null_policy_flag(spark):
    df = orders_df(spark, order(order_id=1, order_amount=None), order(order_id=2))
    got = {r.order_id: r.dq_flag for r in Q.classify(S.clean(df), "flag").collect()}
    assert got == {1: "NULL_ORDER_AMOUNT", 2: "OK"}


def test_dedup_deterministic_and_null_ids_collapse(spark):
    df = orders_df(
        spark,
        order(order_id=1, payment_method="CARD", order_amount=300.0),
        order(order_id=1, payment_method="UPI", order_amount=200.0),
        order(order_id=None, payment_method="COD"),
        order(order_id=None, payment_method="WALLET"),
    )
    a = rows(S.dedup(df, order_by=["order_amount"]))
    b = rows(S.dedup(df.repartition(3), order_by=["order_amount"]))
    assert a == b and len(a) == 2
    kept = {r.order_id: r.order_amount for r in S.dedup(df, order_by=["order_amount"]).collect()}
    assert kept[1] == 200.0


def test_fill_city_final(spark):
    df = orders_df(spark, order(order_id=1, tip_amount=None, discount_amount=None, rating=None,
                                delivery_city=" Ahemdabad "))
    c = S.clean(df, city_aliases={"Ahemdabad": "Ahmedabad"}).first()
    assert (c.tip_amount, c.discount_amount, c.rating) == (0.0, 0.0, 0.0)
    assert c.delivery_city == "AHMEDABAD"
    assert c.final_amount == 500.0
    c2 = S.clean(orders_df(spark, order(order_amount=100.10, discount_amount=0.05,
                                        tip_amount=0.0))).first()
    assert c2.final_amount == 100.05


def test_bands_weekend_high_value(spark):
    df = orders_df(
        spark,
        order(order_id=1, delivery_time_minutes=30, order_date=D(2024, 6, 1)),   # Saturday
        order(order_id=2, delivery_time_minutes=31, order_date=D(2024, 6, 2)),   # Sunday
        order(order_id=3, delivery_time_minutes=60, order_date=D(2024, 6, 3)),   # Monday
        order(order_id=4, delivery_time_minutes=61, order_amount=1029.99, tip_amount=20.0),
        order(order_id=5, delivery_time_minutes=None, order_date=None, order_amount=1030.0),
    )
    got = {r.order_id: (r.delivery_speed_category, r.is_weekend, r.high_value_order)
           for r in S.derive(S.clean(df)).collect()}
    assert got == {1: ("FAST", True, 0), 2: ("MEDIUM", True, 0), 3: ("MEDIUM", False, 0),
                   4: ("SLOW", False, 0), 5: ("SLOW", False, 1)}
    # 1029.99 - 50 + 20 = 999.99 -> not high value; 1030 - 50 + 20 = 1000 -> high value


def test_enrich_left_joins_keep_orphans(spark):
    customers, restaurants, partners = dims(spark)
    df = orders_df(spark, order(order_id=1), order(order_id=2, customer_id=99,
                                                   restaurant_id=98, delivery_partner_id=97))
    e = S.enrich(S.clean(df), customers, restaurants, partners)
    got = {r.order_id: (r.customer_name, r.cuisine_type, r.vehicle_type) for r in e.collect()}
    assert got == {1: ("Asha", "Indian", "BIKE"), 2: (None, None, None)}
    assert e.columns[:3] == ["delivery_partner_id", "restaurant_id", "customer_id"]
    hinted = S.enrich(S.clean(df), customers, restaurants, partners, broadcast_dims=True)
    assert rows(hinted) == rows(e)
    plan = hinted._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    capped = S.enrich(S.clean(df), customers, restaurants, partners, broadcast_dims=1)
    assert rows(capped) == rows(e)  # dimensions over the bound: no hint, same rows
    orph = {r.dimension: (r.orphan_orders, r.orphan_keys) for r in Q.orphans(
        df, {"customers": (customers, "customer_id"),
             "restaurants": (restaurants, "restaurant_id"),
             "partners": (partners, "delivery_partner_id")}).collect()}
    assert orph == {"customers": (1, 1), "restaurants": (1, 1), "partners": (1, 1)}


def test_build_silver_schema(spark):
    customers, restaurants, partners = dims(spark)
    df = orders_df(spark, order(order_id=1), order(order_id=2, order_status="LOST"))
    silver, quarantine = S.build_silver(df, customers, restaurants, partners,
                                        now="2024-01-01 00:00:00")
    assert silver.count() == 1 and quarantine.count() == 1
    assert len(silver.columns) == 34  # 37 in the pipeline minus 3 bronze audit columns
    t = silver.select(F.col("silver_load_time").cast("timestamp_ntz").cast("string")).first()[0]
    assert t == "2024-01-01 05:30:00"


def test_duplicate_dimension_keys(spark):
    customers, restaurants, partners = dims(spark)
    dup_customers = customers.unionByName(customers.filter("customer_id = 1"))
    df = orders_df(spark, order(order_id=1), order(order_id=2, customer_id=2))
    fanned = S.enrich(S.clean(df), dup_customers, restaurants, partners)
    assert fanned.count() == 3  # the pipeline's behaviour: order 1 is doubled
    kept = S.enrich(S.clean(df), dup_customers, restaurants, partners, dedup_dims=True)
    assert kept.count() == 2
    report = {r.dimension: (r.duplicate_keys, r.extra_rows) for r in Q.duplicate_keys(
        {"customers": (dup_customers, "customer_id"),
         "restaurants": (restaurants, "restaurant_id")}).collect()}
    assert report == {"customers": (1, 1), "restaurants": (0, 0)}
    norm = S.enrich(S.clean(df), customers, restaurants, partners, normalise_dims=True)
    assert {r.city for r in norm.collect()} == {"DELHI", "MUMBAI"}
