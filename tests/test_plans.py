"""Plan tests: no Python in any plan; single-partition exchanges only where the
input is bounded (a global aggregate's one row per task, months, cuisines)."""

from conftest import SF001
from ordermart.operators import extensions as X
from ordermart.operators import marts as M
from ordermart.operators import silver as S
from ordermart.sources.adapter import TIEBREAK_COLS, star_schema

# marts whose single-partition exchange sits above a bounded aggregate
BOUNDED_SINGLE = {"gold_order_summary", "gold_monthly_trends"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_unbounded_single_partition(spark):
    st = star_schema(spark, SF001)
    silver, quarantine = S.build_silver(st.orders, st.customers, st.restaurants, st.partners,
                                        now="2001-08-02 00:00:00", heavy_rows=0,
                                        order_by=TIEBREAK_COLS, drop=TIEBREAK_COLS)
    for df in (silver, quarantine):
        p = _plan(df)
        assert "Python" not in p and "SinglePartition" not in p
    for name, build in M.MART_FUNCTIONS.items():
        p = _plan(build(silver, "2001-08-02"))
        assert "Python" not in p, name
        if name not in BOUNDED_SINGLE and name not in ("gold_restaurant_performance",
                                                       "gold_customer_rfm"):
            assert "SinglePartition" not in p, name
    # the rank marts on their bucket-parallel path
    for df in (M.restaurant_performance(silver, small_rows=0),
               M.customer_rfm(silver, "2001-08-02", small_rows=0),
               X.partner_speed_rank(silver, small_rows=0),
               X.customer_dense_rank(silver, heavy_rows=0)):
        p = _plan(df)
        assert "Python" not in p and "SinglePartition" not in p
