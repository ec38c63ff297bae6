"""Hand-made rows for unit tests (FIXTURES.md section 6)."""

import datetime as dt

from ordermart.schemas import (CUSTOMERS_RAW, ORDERS_RAW, PARTNERS_RAW, RESTAURANTS_RAW)

D = dt.date
TS = dt.datetime

BASE = dict(order_id=1, customer_id=1, restaurant_id=1, delivery_partner_id=1,
            order_date=D(2024, 6, 3), order_timestamp=TS(2024, 6, 3, 12, 0),
            delivery_city=" delhi ", payment_method="UPI", order_status="DELIVERED",
            delivery_time_minutes=25, order_amount=500.0, tip_amount=20.0,
            discount_amount=50.0, final_amount=None, rating=4.0)


def order(**kw):
    r = dict(BASE)
    r.update(kw)
    return tuple(r[f.name] for f in ORDERS_RAW.fields)


def orders_df(spark, *rows):
    return spark.createDataFrame(list(rows), ORDERS_RAW)


def dims(spark):
    customers = spark.createDataFrame([
        (1, "Asha", "F", 30, "Delhi", D(2023, 1, 1), "GOLD"),
        (2, "Ravi", "M", 40, "Mumbai", D(2023, 2, 1), "SILVER"),
        (3, "Meera", "F", 25, "Pune", D(2023, 3, 1), "REGULAR"),
    ], CUSTOMERS_RAW)
    restaurants = spark.createDataFrame([
        (1, "Spice", "Indian", "Delhi", 20, 4.5),
        (2, "Wok", "Chinese", "Mumbai", 15, 4.0),
    ], RESTAURANTS_RAW)
    partners = spark.createDataFrame([
        (1, "P1", "BIKE", D(2022, 1, 1), "Delhi"),
        (2, "P2", "SCOOTER", D(2022, 2, 1), "Mumbai"),
    ], PARTNERS_RAW)
    return customers, restaurants, partners
