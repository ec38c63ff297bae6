"""Raw CSV files in compressed pieces, and the query over malformed records that stages them."""

import os

from pyspark.sql import functions as F

from conftest import rows
from fixtures import dims, order, orders_df
from ordermart.plans import catalog
from ordermart.sinks import writers
from ordermart.sources import raw
from ordermart.sources.adapter import TIEBREAK_COLS, StarSchema


def test_raw_csv_in_compressed_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "RAW_FILE_ROWS", 10)
    df = spark.createDataFrame([(i, (" a ", 'say "x", y', "", None, "é")[i % 5]) for i in range(35)], "k long, v string").coalesce(1)
    for codec, ending in ((None, ".csv"), ("gzip", ".csv.gz")):
        path = writers.write_raw_csv(df, str(tmp_path / ending), codec)
        files = [f for f in os.listdir(path) if f.startswith("part-")]
        assert all(f.endswith(ending) for f in files) and len(files) == (4 if codec else 1)
        if codec:
            assert rows(raw.read_csv(spark, path, df.schema)) == plain
        plain = rows(raw.read_csv(spark, path, df.schema))


def test_malformed_raw_files_are_compressed(spark, monkeypatch):
    orders = orders_df(spark, *[order(order_id=i % 50, order_amount=float(100 + i)) for i in range(120)])
    c = catalog.Ctx(spark, "")
    c.star = StarSchema(orders.withColumns({x: F.col("order_amount") for x in TIEBREAK_COLS}), *dims(spark))
    paths, write = [], catalog.write_raw_csv
    monkeypatch.setattr(catalog, "write_raw_csv", lambda *a, **b: paths.append(write(*a, **b)) or paths[-1])
    got = {r["metric"]: r["value"] for r in catalog._src_malformed(c).collect()}
    found = [f for f in os.listdir(paths[0]) if f.startswith("part-")]
    assert found and all(f.endswith(".csv.gz") for f in found)
    ids = [i % 50 for i in range(120)]
    broken = sum(any(i % m == 0 for m in (11, 13, 17)) for i in ids)
    assert got["rows_in"] == 120 and got["malformed"] == got["records_kept"] == broken
    assert got["merged_duplicates"] == 120 - broken - len({i for i in ids if all(i % m for m in (11, 13, 17))})
    assert got["valid"] + got["quarantine"] + got["merged_duplicates"] == 120
