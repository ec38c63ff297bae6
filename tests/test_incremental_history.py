"""Day-by-day history against the full build."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ordermart.operators import history as H
from ordermart.operators.incremental_history import HistoryStore
from ordermart.sinks import manifests

SCHEMA = "order_id long, customer_id long, order_date date, final_amount double, note string"
COLS = ["order_id", "customer_id", "order_date", "final_amount", "note", *H.OUT_COLS]
DAY = dt.date(2024, 1, 1)


def orders(seed, n=600, days=12, customers=25):
    rnd = random.Random(seed)
    return [(i, None if rnd.random() < 0.15 else rnd.randint(1, customers), DAY + dt.timedelta(rnd.randint(0, days)),
             None if rnd.random() < 0.05 else rnd.randint(-500, 90000) / 100, "x") for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def full(spark, data):
    return rows(H.customer_history_window(frame(spark, data)), COLS)


def batches_by_day(data, late_share, seed):
    """Orders by day, some of them only some days later."""
    rnd, out = random.Random(seed), {}
    for r in data:
        late = rnd.randint(1, 6) if rnd.random() < late_share else 0
        out.setdefault(r[2] + dt.timedelta(late), []).append(r)
    return [out[d] for d in sorted(out)]


@pytest.mark.parametrize("late_share", [0.0, 0.03])
def test_day_by_day_equals_full_build(spark, tmp_path, late_share):
    data = orders(1)
    store = HistoryStore(spark, str(tmp_path / "h"))
    seen, ahead, again = [], 0, 0
    for i, batch in enumerate(batches_by_day(data, late_share, 2)):
        got = store.advance(frame(spark, batch))
        seen += batch
        ahead, again = ahead + got["ahead"], again + got["rebuilt"]
        if i in (0, 1, 4):
            assert rows(store.rows(), COLS) == full(spark, seen)
    assert rows(store.rows(), COLS) == full(spark, data)
    assert (again > 0) == (late_share > 0) and ahead > 0
    # the state is that of all rows
    state = {r.customer_id: (r.n, r.last_day) for r in store.state().collect()}
    want = {r.customer_id: (r.n, r.d) for r in frame(spark, data).groupBy("customer_id").agg(
        F.count("*").alias("n"), F.max("order_date").alias("d")).collect()}
    assert state == want


def test_same_day_orders_in_two_batches(spark, tmp_path):
    first = [(1, 7, DAY, 10.0, "a"), (2, 8, DAY, 1.0, "a"), (3, None, None, 4.0, "a")]
    second = [(0, 7, DAY, 5.0, "b"), (4, 9, DAY, None, "b"), (5, None, None, 6.0, "b"), (6, 8, DAY + dt.timedelta(1), None, "b")]
    third = [(7, 9, DAY + dt.timedelta(2), 3.0, "c"), (8, 8, DAY + dt.timedelta(3), 2.5, "c")]
    store = HistoryStore(spark, str(tmp_path / "h"))
    for b in (first, second, third):
        store.advance(frame(spark, b))
    assert rows(store.rows(), COLS) == full(spark, first + second + third)


def test_heavy_customers_take_the_bucketed_path(spark, tmp_path):
    data = orders(3, n=400, days=4, customers=3)
    store = HistoryStore(spark, str(tmp_path / "h"), heavy_rows=20)
    for batch in batches_by_day(data, 0.05, 4):
        store.advance(frame(spark, batch))
    assert rows(store.rows(), COLS) == full(spark, data)


def test_a_failing_batch_leaves_the_store(spark, tmp_path, monkeypatch):
    store = HistoryStore(spark, str(tmp_path / "h"))
    data = orders(5, n=80)
    store.advance(frame(spark, data[:40]))
    before = rows(store.rows(), COLS)
    monkeypatch.setattr(store, "_next_state", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.advance(frame(spark, data[40:]))
    monkeypatch.undo()
    assert rows(store.rows(), COLS) == before
    store.advance(frame(spark, data[40:]))
    assert rows(store.rows(), COLS) == full(spark, data)


def test_two_writers_of_one_batch(spark, tmp_path):
    path = str(tmp_path / "m" / "batch-000000")
    assert manifests.write_once(spark, path, "one") and not manifests.write_once(spark, path, "two")
    assert manifests.read(spark, path) == "one"
    assert manifests.read_text(spark, str(tmp_path / "m"), "batch-") == [("batch-000000", "one")]
    tmp, _ = manifests._file_system(spark, str(tmp_path / "m" / ".x"))
    (tmp_path / "m" / ".x").write_text("two")
    assert not manifests._rename_new(spark, tmp, manifests._file_system(spark, path)[0])
    assert manifests.read(spark, path) == "one"
