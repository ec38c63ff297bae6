"""Tables whose columns change, activity bit sets and sketches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from ordermart.operators import activity as A
from ordermart.operators import extensions as X
from ordermart.operators import marts as M
from ordermart.operators import sketches as K
from ordermart.sinks.evolving import EvolvingTable, SchemaConflict, conflicts
from ordermart.sources.adapter import TIEBREAK_COLS, star_schema


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_added_widened_and_absent_columns(spark, tmp_path):
    t = EvolvingTable(spark, str(tmp_path / "t"))
    t.write(frame(spark, "id int, day date, city string", (1, dt.date(2024, 1, 2), "a")))
    t.write(frame(spark, "city string, id bigint, day timestamp_ntz, extra double", ("b", 2 ** 40, dt.datetime(2024, 1, 3, 4, 5), 0.5)))
    t.write(frame(spark, "id int, extra double", (3, 1.5)))
    assert t.schema().simpleString() == "struct<id:bigint,day:timestamp_ntz,city:string,extra:double>"
    assert sorted(map(tuple, t.read_all("v").collect())) == [
        (1, dt.datetime(2024, 1, 2), "a", None, 0), (3, None, None, 1.5, 2), (2 ** 40, dt.datetime(2024, 1, 3, 4, 5), "b", 0.5, 1)]
    assert t.read().collect() == [(3, None, None, 1.5)] and t.read(0).first().id == 1
    assert sorted(map(tuple, t.changes().collect()), key=str) == sorted([
        (1, "id", "widened", "int", "bigint"), (1, "day", "widened", "date", "timestamp_ntz"), (1, "extra", "added", None, "double"),
        (2, "day", "absent", "timestamp_ntz", None), (2, "city", "absent", "string", None)], key=str)


def test_contradicting_types_are_refused(spark, tmp_path):
    t = EvolvingTable(spark, str(tmp_path / "t"))
    t.write(frame(spark, "id int, city string", (1, "a")))
    with pytest.raises(SchemaConflict, match="city: string -> int"):
        t.write(frame(spark, "id int, city int", (1, 2)))
    assert t.read_all().count() == 1 and len(t.versions()) == 1
    assert conflicts(frame(spark, "a bigint", (1,)).schema, frame(spark, "a int", (1,)).schema) == []
    t.write(frame(spark, "id int, city int", (1, 2)), replace=True)
    assert t.read_all().collect() == [(1, 2)]
    t.write(frame(spark, "id int, city bigint", (5, 6)))
    assert sorted(t.read_all().collect()) == [(1, 2), (5, 6)]


def test_writers_of_one_version(spark, tmp_path, monkeypatch):
    one, two = (EvolvingTable(spark, str(tmp_path / "t")) for _ in range(2))
    seen = two.versions()
    one.write(frame(spark, "id int", (1,)))
    monkeypatch.setattr(two, "versions", lambda: seen)
    with pytest.raises(RuntimeError):
        two.write(frame(spark, "id int", (2,)))


def orders(spark, seed=1, n=3000):
    rnd = random.Random(seed)
    day = lambda: None if rnd.random() < 0.02 else dt.date(1969, 6, 1) + dt.timedelta(rnd.randint(0, 4000))
    data = [(i, None if rnd.random() < 0.1 else rnd.randint(1, 200), day()) for i in range(n)]
    data += [(n, 999, None)]
    return spark.createDataFrame(data, "order_id long, customer_id long, order_date date").repartition(4).cache()


def test_activity_equals_the_direct_marts(spark):
    df = orders(spark)
    rows_ = A.activity(df)
    cols = ["customer_id", "active_months"]
    assert rows(A.active_months(rows_), cols) == rows(M.customer_retention(df), cols)
    cols = ["cohort_month", "month_offset", "customers"]
    assert rows(A.cohorts(rows_), cols) == rows(X.cohort_retention(df), cols)
    parts = A.activity(df.filter("order_id % 3 = 0")).unionByName(A.activity(df.filter("order_id % 3 <> 0")))
    assert rows(A.active_months(A.merge(parts))) == rows(A.active_months(rows_))
    assert rows(A.cohorts(A.merge(parts)), cols) == rows(A.cohorts(rows_), cols)
    assert A.active_months(A.activity(df.limit(0))).count() == 0


def test_activity_shuffles_the_fact_once(spark):
    plan = A.active_months(A.activity(orders(spark)))._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1


def test_sketches_within_their_bound_on_every_cut(spark):
    o = star_schema(spark, "/root/testdata/sf0.01").orders.drop(*TIEBREAK_COLS).cache()
    sketches = K.build(o).cache()
    for by in ([], ["delivery_city"], ["order_month"], ["delivery_city", "order_month"]):
        got = {tuple(r[c] for c in by): r for r in K.cut(sketches, by).collect()}
        want = {tuple(r[c] for c in by): r for r in K.exact_cut(o, by).collect()}
        assert got.keys() == want.keys()
        for k, w in want.items():
            assert all(abs(got[k][n] - w[n]) <= max(1, K.ERROR_BOUND * w[n]) for n in K.KEYS), (by, k)
    half = [K.build(o.filter(c)) for c in ("order_id % 2 = 0", "order_id % 2 = 1")]
    merged, exact = K.cut(K.merge(half[0].unionByName(half[1]))).first(), K.exact_cut(o).first()
    assert all(abs(merged[n] - exact[n]) <= K.ERROR_BOUND * exact[n] for n in K.KEYS)
    assert K.cut(K.build(o.limit(0))).first().customers == 0
