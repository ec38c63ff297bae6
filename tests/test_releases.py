"""Publishing without gaps: numbered pointers, replaced views, one switch for a set."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from ordermart.session import scratch_path
from ordermart.sinks import manifests, releases, writers
from ordermart.sources import raw


def value(df):
    return df.agg(F.min("run"), F.max("run"), F.count("*")).first()


def test_readers_never_fail_during_publishes(spark):
    root, errors, seen, stop = scratch_path(spark, "t-loop"), [], [], threading.Event()
    writers.ensure_database(spark, "ordermart_loop", scratch_path(spark, "t-loop-db"))
    table = lambda i: spark.range(5 + i).select("id", F.lit(i).alias("run"), F.lit("x").alias("city"))
    publish = lambda i: writers.publish_folder(table(i), os.path.join(root, "t"), "ordermart_loop.t", partition_cols=["city"])
    publish(0)

    def loop():
        while not stop.is_set():
            try:
                for df in (raw.read_path(spark, writers.current_path(spark, os.path.join(root, "t"))), spark.table("ordermart_loop.t")):
                    low, high, n = value(df)
                    assert low == high and n == 5 + low
                    seen.append(low)
            except Exception as e:  # noqa: BLE001
                errors.append(str(e)[:300])

    reader = threading.Thread(target=loop)
    reader.start()
    for i in range(1, 11):
        publish(i)
    stop.set()
    reader.join()
    assert not errors and seen
    assert value(spark.table("ordermart_loop.t"))[0] == 10
    own = [r.tableName for r in spark.sql("SHOW TABLES IN ordermart_loop LIKE 't__v_*'").collect()]
    assert len(own) == writers.KEEP_VERSIONS


def test_a_table_of_an_older_layout_becomes_a_view(spark):
    writers.ensure_database(spark, "ordermart_old", scratch_path(spark, "t-old-db"))
    writers.save_table(spark.range(3).toDF("a"), "ordermart_old.t", scratch_path(spark, "t-old"))
    writers.publish_folder(spark.range(4).toDF("b"), scratch_path(spark, "t-new"), "ordermart_old.t")
    assert spark.table("ordermart_old.t").columns == ["b"] and spark.table("ordermart_old.t").count() == 4


def sets(spark, i):
    return {n: spark.range(k + i).select("id", F.lit(i).alias("run")) for n, k in (("a", 2), ("b", 30), ("c", 4))}


def runs_of(spark, root):
    now = releases.current_release(spark, root)
    return {n: value(now.read(n))[0] for n in now.tables}


def test_a_kill_between_any_two_writes_leaves_one_set(spark, monkeypatch):
    root = scratch_path(spark, "t-set")
    with pytest.raises(FileNotFoundError):
        releases.current_release(spark, root)
    releases.publish_release(spark, sets(spark, 0), root)

    class Killed(BaseException):
        pass

    steps = [(writers, "write_overwrite", n) for n in range(3)] + [(manifests, "_rename_new", 0)]
    for module, name, after in steps:
        real, calls = getattr(module, name), []

        def dying(*a, **k):
            if len(calls) == after:
                raise Killed
            calls.append(1)
            return real(*a, **k)

        monkeypatch.setattr(module, name, dying)
        with pytest.raises(Killed):
            releases.publish_release(spark, sets(spark, 1), root)
        monkeypatch.undo()
        assert runs_of(spark, root) == {"a": 0, "b": 0, "c": 0}
    # after the switch the new set is there, whatever follows
    monkeypatch.setattr(releases, "clean", lambda *a: (_ for _ in ()).throw(Killed()))
    with pytest.raises(Killed):
        releases.publish_release(spark, sets(spark, 2), root)
    monkeypatch.undo()
    assert runs_of(spark, root) == {"a": 2, "b": 2, "c": 2}


def test_versions_are_kept_and_carried(spark):
    root = scratch_path(spark, "t-kept")
    for i in range(6):
        held = releases.publish_release(spark, sets(spark, i), root, parallelism=3)
    releases.publish_release(spark, {"b": sets(spark, 9)["b"]}, root)
    assert runs_of(spark, root) == {"a": 5, "b": 9, "c": 5}
    assert {n: value(held.read(n))[0] for n in "abc"} == {"a": 5, "b": 5, "c": 5}  # an older reader still can
    assert len(manifests.names(spark, os.path.join(root, releases.RUNS), releases.RUN)) == releases.KEEP_RUNS
    assert len(manifests.folders(spark, os.path.join(root, "a"), "v-")) == releases.KEEP_RUNS - 1


def test_two_publishers(spark):
    root = scratch_path(spark, "t-two")
    releases.publish_release(spark, sets(spark, 0), root)
    real, other = manifests.write_once, []

    def slower(*a):
        if not other:  # another run publishes just before
            other.append(1)
            manifests.write_once = real
            releases.publish_release(spark, {"a": sets(spark, 1)["a"]}, root)
        return real(*a)

    manifests.write_once = slower
    try:
        releases.publish_release(spark, {"b": sets(spark, 2)["b"]}, root)
    finally:
        manifests.write_once = real
    assert runs_of(spark, root) == {"a": 1, "b": 2, "c": 0}


def test_catalog_and_partitions(spark):
    root = scratch_path(spark, "t-cat")
    df = spark.createDataFrame([(1, "007"), (2, ""), (3, None)], "id long, city string")
    now = releases.publish_release(spark, {"t": df, "u": spark.range(2).toDF("k")}, root, {"t": ["city"]}, "ordermart_rel")
    assert sorted(map(tuple, now.read("t").select("id", "city").collect())) == [(1, "007"), (2, ""), (3, None)]
    assert spark.table("ordermart_rel.u").count() == 2 and spark.table("ordermart_rel.t").count() == 3
