"""Registered queries against their DuckDB twins on the small tables.

The full sweep over every key at sf0.01 is ``python tools/oracle_check.py``;
this runs a representative subset at sf0.001 to keep the suite quick.
"""

import os
import sys

import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import check, duck  # noqa: E402
from ordermart.plans import catalog  # noqa: E402

KEYS = ["kpi_order_summary", "kpi_restaurant_performance", "kpi_customer_rfm",
        "kpi_top_customers", "kpi_monthly_trends", "silver_orders", "dq_summary",
        "ext_customer_dense_rank", "ext_cohort_retention", "sql_rfm_top10", "dq_orphans",
        "win_history_null_heavy", "src_csv_malformed", "src_csv_dimensions"]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = check(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF001)
    assert r["status"] == "ok", r.get("issues")


def test_every_query_has_sql():
    """Every query of the library; of the optional ones, those that SQL can express."""
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "segment" in df.columns
