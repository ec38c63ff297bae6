import os

from pyspark.sql import functions as F

from conftest import SF001, rows
from ordermart.operators import marts as M
from ordermart.plans import pipeline
from ordermart.schemas import ORDERS_RAW
from ordermart.session import scratch_path
from ordermart.sinks import writers
from ordermart.sources import bronze, raw
from ordermart.sources.adapter import star_schema
from ordermart.streaming.incremental import ingest_available


def _land(spark, root):
    """Raw CSVs derived from the sf0.001 tables (as an upstream system drops them)."""
    star = star_schema(spark, SF001)
    paths, schemas = {}, {}
    for name, df in star.as_dict().items():
        if name == "orders":
            # the raw orders file carries a (discarded) source final_amount
            df = df.withColumn("final_amount", F.lit(None).cast("double")).select(
                *[f.name for f in ORDERS_RAW.fields])
        p = os.path.join(root, "landing", name)
        writers.write_raw_csv(df, p)
        paths[name], schemas[name] = p, df.schema
    return star, paths, schemas


def test_csv_roundtrip_and_audit(spark):
    root = scratch_path(spark, "t-io")
    star, paths, schemas = _land(spark, root)
    back = raw.read_csv(spark, paths["customers"], schemas["customers"])
    assert rows(back) == rows(star.customers)
    b = bronze.ingest_csv(spark, paths["orders"], schemas["orders"], now="2024-01-01 00:00:00")
    r = b.select("source_file", "bronze_layer").distinct().collect()
    assert all(x.source_file.endswith(".csv") and x.bronze_layer == "bronze" for x in r)
    assert b.count() == star.orders.count()


def test_partitioned_write_and_table(spark):
    df = spark.createDataFrame([(i, f"c{i % 3}") for i in range(100)], "id long, city string")
    p = writers.write_partitioned(df, scratch_path(spark, "t-part"), ["city"], spread_by=["id"])
    p2 = writers.write_partitioned(df, scratch_path(spark, "t-part2"), ["city"])
    assert rows(raw.read_path(spark, p2), ["id", "city"]) == rows(df)
    assert sorted(d for d in os.listdir(p) if d.startswith("city=")) == ["city=c0", "city=c1", "city=c2"]
    assert rows(raw.read_path(spark, p), ["id", "city"]) == rows(df)
    writers.ensure_database(spark, "ordermart_t", scratch_path(spark, "t-db"))
    writers.save_table(df, "ordermart_t.cities", scratch_path(spark, "t-tab"))
    assert rows(spark.table("ordermart_t.cities"), ["id", "city"]) == rows(df)
    man = dict(writers.manifest({"a": df, "b": df.filter("id < 10")}).collect())
    assert man == {"a": 100, "b": 10}


def test_pipeline_run_end_to_end(spark):
    root = scratch_path(spark, "t-run")
    _, paths, _ = _land(spark, root)
    from ordermart import session
    before = session.staged_mark()
    out = pipeline.run(spark, paths, os.path.join(root, "out"), as_of="2001-08-02",
                       now="2001-08-02 00:00:00", database="ordermart_run")
    assert session.staged_mark() == before  # staged intermediates were released
    man = dict(out["manifest"].collect())
    summ = dict(out["dq_summary"].collect())
    assert man["silver_orders"] == summ["valid_records"]
    assert man["quarantine_orders"] == summ["quarantine_records"]
    assert man["silver_orders"] + man["quarantine_orders"] == summ["total_records"]
    assert len(out["gold"]) == 12
    silver = raw.read_path(spark, out["silver_orders"])
    assert {"ingestion_timestamp", "source_file", "bronze_layer"} <= set(silver.columns)
    # gold revenue adds up to silver revenue
    total = M.order_summary(silver).first().total_revenue
    by_city = raw.read_path(spark, out["gold"]["gold_revenue_city"]).agg(
        F.sum("total_revenue")).first()[0]
    assert abs(total - by_city) < 1e-6
    assert spark.table("ordermart_run.gold_order_summary").count() == 1
    names = {r.tableName for r in writers.list_tables(spark, "ordermart_run").collect()}
    assert {f"gold_{x}" for x in ("order_summary", "customer_rfm", "peak_hours")} <= names
    top = M.present("gold_revenue_city",
                    raw.read_path(spark, out["gold"]["gold_revenue_city"]), limit=3).collect()
    assert len(top) == 3 and top[0].total_revenue >= top[1].total_revenue >= top[2].total_revenue


def test_incremental_bronze_stream(spark):
    root = scratch_path(spark, "t-stream")
    star, paths, schemas = _land(spark, root)
    target, ckpt = os.path.join(root, "bronze"), os.path.join(root, "ckpt")
    n1 = ingest_available(spark, paths["partners"], schemas["partners"], target, ckpt)
    assert n1 == star.partners.count()
    # a second run sees no new files: nothing is appended twice
    n2 = ingest_available(spark, paths["partners"], schemas["partners"], target, ckpt)
    assert n2 == 0
    out = raw.read_path(spark, target)
    assert out.count() == n1 and "source_file" in out.columns


def test_cli_runs_pipeline(spark, capsys):
    from ordermart.__main__ import main
    root = scratch_path(spark, "t-cli")
    _, paths, _ = _land(spark, root)
    args = [f"--{k}={v}" for k, v in paths.items()] + [f"--target={root}/out",
                                                       "--as-of=2001-08-02"]
    main(args)
    import json
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["manifest"]["silver_orders"] == out["dq_summary"]["valid_records"]
    assert len(out["gold"]) == 12
