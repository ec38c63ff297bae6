"""All twelve marts from day-grain states against the direct marts."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from ordermart.operators import marts as M
from ordermart.operators import silver as S
from ordermart.operators.mart_states import MANY_GROUPS, STATES, MartStates
from ordermart.session import materialize
from ordermart.sources.adapter import TIEBREAK_COLS, star_schema

AS_OF = "2001-08-02"


@pytest.fixture(scope="module")
def silver(spark):
    st = star_schema(spark, SF001)
    s, _ = S.build_silver(st.orders, st.customers, st.restaurants, st.partners, now="2001-08-02 00:00:00",
                          order_by=TIEBREAK_COLS, drop=TIEBREAK_COLS)
    # rows with missing values in every place that a mart looks at
    k = F.col("order_id") % 41
    s = s.withColumns({"final_amount": F.when(k != 1, F.col("final_amount")), "rating": F.when(k != 2, F.col("rating")),
                       "order_date": F.when(k != 3, F.col("order_date")), "delivery_city": F.when(k != 4, F.col("delivery_city")),
                       "order_status": F.when(k != 5, F.col("order_status")),
                       "delivery_time_minutes": F.when(k != 6, F.col("delivery_time_minutes"))})
    return materialize(s, "t-states-silver")


def assert_equal_marts(got, want):
    assert got.keys() == want.keys()
    for name, df in want.items():
        assert sorted(got[name].columns) == sorted(df.columns), name
        assert dict(got[name].dtypes) == dict(df.dtypes), name
        assert rows(got[name], df.columns) == rows(df), name


def test_marts_of_several_batches(spark, silver, tmp_path):
    states = MartStates(spark, str(tmp_path / "s"))
    with pytest.raises(FileNotFoundError):
        states.states()
    for i in range(3):
        states.add(silver.filter(F.col("order_id") % 3 == i))
    want = M.all_marts(silver, AS_OF)
    assert_equal_marts(states.marts(AS_OF), want)
    states.compact()
    assert_equal_marts(states.marts(AS_OF), want)


def test_rows_taken_back(spark, silver, tmp_path):
    states, gone = MartStates(spark, str(tmp_path / "s")), F.col("customer_id") % 4 == 0
    states.add(silver)
    states.compact()
    states.add(silver.filter(gone), sign=-1)
    left = silver.filter(~F.coalesce(gone, F.lit(False)))
    assert_equal_marts(states.marts(AS_OF), M.all_marts(left, AS_OF))


def test_no_rows(spark, silver, tmp_path):
    states = MartStates(spark, str(tmp_path / "s"))
    states.add(silver.limit(0))
    assert_equal_marts(states.marts(AS_OF), M.all_marts(silver.limit(0), AS_OF))


def exchanges(df):
    return str(df._jdf.queryExecution().executedPlan()).count("Exchange hashpartitioning")


def test_bucketed_states(spark, silver, tmp_path):
    """Batches in buckets and a small plain one between them: the same marts; sums by
    the keys of a state shuffle nothing that is in buckets."""
    folder, k = str(tmp_path / "s"), F.col("order_id") % 4
    tables = {t.name for t in spark.catalog.listTables()}
    states = MartStates(spark, folder, buckets_from=0)
    states.add(silver.filter(k == 0))
    states.add(silver.filter((k == 1) | (k == 3)))
    for name in MANY_GROUPS:
        assert exchanges(states.states()[name].groupBy(*STATES[name][0]).sum("n_rows")) == 0, name
    states.compact()
    states.add(silver.filter(k == 3), sign=-1)
    for name in MANY_GROUPS:
        keys, state = STATES[name][0], states.states()[name]
        summed = state.groupBy(*keys).sum("n_rows")
        assert exchanges(summed) == 0 and len(rows(summed)) == len({r for r in rows(state, keys)}), name
    assert_equal_marts(states.marts(AS_OF), M.all_marts(silver.filter(k < 2), AS_OF))
    MartStates(spark, folder).add(silver.filter(k == 2))  # plain files
    states.compact()
    assert_equal_marts(states.marts(AS_OF), M.all_marts(silver.filter(k < 3), AS_OF))
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_bucketed_states_without_rows(spark, silver, tmp_path):
    states = MartStates(spark, str(tmp_path / "s"), buckets_from=0)
    states.add(silver.limit(0))
    states.compact()
    assert_equal_marts(states.marts(AS_OF), M.all_marts(silver.limit(0), AS_OF))


def test_small_batches_are_plain_files(spark, silver, tmp_path):
    states = MartStates(spark, str(tmp_path / "s"))
    states.add(silver)
    states.compact()
    assert [c["buckets"] for c in states._commits()] == [0, 0]


def test_monthly_trends_of_bucketed_days(spark, silver, tmp_path):
    """The customers of a month come from day states of several batches: each pair once,
    and a pair whose rows were all taken back not at all."""
    states, k = MartStates(spark, str(tmp_path / "s"), buckets_from=0), F.col("order_id") % 3
    states.add(silver.filter(k < 2))
    states.add(silver.filter(k == 2))
    states.compact()
    states.add(silver.filter(k == 1), sign=-1)
    left = silver.filter(k != 1)
    assert rows(states.builders(AS_OF)["gold_monthly_trends"]()) == rows(M.monthly_trends(left))
    assert [c["buckets"] > 0 for c in states._commits()] == [True] * 4
