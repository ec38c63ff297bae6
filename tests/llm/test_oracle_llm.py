"""The llm queries that SQL can express against their DuckDB twins."""

import os
import sys

import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))

from oracle_check import check, duck  # noqa: E402
from ordermart.llm import queries  # noqa: E402


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, key):
    r = check(spark, duck(SF001), key, queries.queries()[key], queries.oracle_sql()[key], SF001)
    assert r["status"] == "ok", r.get("issues")


def test_registered_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
