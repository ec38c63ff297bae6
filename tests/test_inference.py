"""Inferred types of delimited text: every kind, mixed columns, several headers."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.schemas import CORRUPT_COL
from ordermart.sources import inference as I


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


VALUES = {
    "boolean": ["true", "FALSE", "True"],
    "integer": ["0", "-7", "+12", "2147483647", "-2147483648", "007"],
    "long": ["2147483648", "-9223372036854775808", "9223372036854775807"],
    "double": ["1.5", ".5", "3.", "-1e10", "1E-3", "9223372036854775808", "123456789012345678901234567890"],
    "date": ["2024-01-31", "2024-2-9"],
    "timestamp": ["2024-01-31 10:20", "2024-01-31T10:20:30", "2024-1-3 1:02:03.456"],
    "string": ["x", "1,5", "2024-02-30", "1.2.3", "12:30", "2024-13-01", "1d", "NaN?", "yes", "2024-01-31 25:00:00", "--1", " "],
}


def test_kind_of_each_value(spark):
    rows = [(v, k) for k, vs in VALUES.items() for v in vs]
    got = spark.createDataFrame(rows, "v string, k string").withColumn("got", I.kind_of(F.col("v"))).collect()
    assert {r.v: r.got for r in got} == {v: k for v, k in rows}
    assert spark.sql("SELECT CAST(NULL AS string) v").select(I.kind_of(F.col("v"))).first()[0] is None


def test_kinds_of_values_between_the_patterns(spark):
    """A dash in the fifth place without a date, signs alone, padded and first-letter cases."""
    want = {"123e-5": "double", "1234-5": "string", "2024-": "string", "-": "string", "+": "string", ".": "string", ":1": "string",
            "*1": "string", "1:2": "string", " 5": "string", "5 ": "string", "": "string", "tRue": "boolean", "+007": "integer",
            "-.5e+3": "double", "2024-02-30 10:00": "string", "99999999999999999999": "double", "9999-12-31": "date"}
    got = spark.createDataFrame([(v,) for v in want], "v string").withColumn("got", I.kind_of(F.col("v"))).collect()
    assert {r.v: r.got for r in got} == want


def test_one_survey_serves_all_tolerances(spark, tmp_path, monkeypatch):
    """The values are counted once, and each decision is that of a pass of its own."""
    folder = tmp_path / "raw"
    write(folder, "a.csv", ["id,v,none", *[f"{i},{i if i % 20 else 'n/a'}," for i in range(100)]])
    write(folder, "b.csv", ["v,id", "7,x"])
    seen = I.survey(spark, str(folder))
    assert seen.counts["v"] == dict.fromkeys(I.KINDS, 0) | {"integer": 96, "string": 5}
    assert seen.nulls == {"id": 0, "v": 0, "none": 101}
    for tolerance in (0.0, 0.02, 0.1):
        assert I.infer(spark, seen, tolerance) == I.infer(spark, str(folder), tolerance)
    monkeypatch.setattr(I, "variants", None)  # nothing left to read for the strict types
    monkeypatch.setattr(I, "_all_text", None)
    assert {c.name: c.kind for c in I.infer(spark, seen).columns} == {"id": "string", "v": "string", "none": "string"}


@pytest.mark.parametrize("kinds,want", [
    ((), "string"), (("integer",), "integer"), (("integer", "long"), "long"), (("integer", "double"), "double"),
    (("date", "timestamp"), "timestamp"), (("integer", "date"), "string"), (("boolean", "integer"), "string"),
    (("boolean",), "boolean"), (("timestamp",), "timestamp")])
def test_least_upper_type(kinds, want):
    assert I.narrowest({k: int(k in kinds) for k in I.KINDS}) == want


def test_tolerance_prefers_a_type_with_few_rejects():
    counts = dict.fromkeys(I.KINDS, 0) | {"integer": 96, "double": 2, "string": 2}
    assert I.narrowest(counts) == "string"
    assert I.narrowest(counts, 0.02) == "double" and I.narrowest(counts, 0.05) == "double"
    assert I.narrowest(counts, 0.01) == "string" and I.rejects(counts, "double") == 2


def test_files_with_different_headers(spark, tmp_path):
    folder = tmp_path / "raw"
    write(folder, "a.csv", ["id,day,amount,note", "1,2024-01-01,2.5,\"a, b\"", "2,,3,", "3000000000,2024-01-02 10:00:00,7,x"])
    write(folder, "b.csv", ["day,id,extra,amount", "2024-02-01,4,true,n/a", "2024-02-02,5,false,8"])
    write(folder, "empty.csv", [])
    found = I.infer(spark, str(folder))
    assert [v.header for v in found.variants] == [("id", "day", "amount", "note"), ("day", "id", "extra", "amount")]
    assert {c.name: c.kind for c in found.columns} == {
        "id": "long", "day": "timestamp", "amount": "string", "note": "string", "extra": "boolean"}
    assert {c.name: c.nulls for c in found.columns} == {"id": 0, "day": 1, "amount": 0, "note": 3, "extra": 3}
    rows = {r.id: r for r in I.read_inferred(spark, found).collect()}
    assert rows[1].note == "a, b" and rows[4].extra is True and rows[4].note is None and rows[3000000000].day.hour == 10
    assert rows[5].day.month == 2 and rows[2].amount == "3"

    loose = I.infer(spark, str(folder), tolerance=0.2)
    amount = next(c for c in loose.columns if c.name == "amount")
    assert (amount.kind, amount.rejected, amount.examples) == ("double", 1, ("n/a",))
    read = I.read_inferred(spark, loose, corrupt=True).filter(F.col(CORRUPT_COL).isNotNull()).cache()
    assert [(r.id, r.amount) for r in read.collect()] == [(4, None)]

    declared = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("day", T.DateType()),
                             T.StructField("amount", T.DoubleType()), T.StructField("gone", T.StringType()),
                             T.StructField("note", T.StringType())])
    got = {r.column_name: (r.status, r.rejected) for r in I.drift(spark, found, declared).collect()}
    assert got == {"id": ("wider", 1), "day": ("wider", 1), "amount": ("wider", 1), "gone": ("missing", 0),
                   "note": ("moved", 0), "extra": ("added", 0)}


def test_same_as_declared_and_narrower(spark, tmp_path):
    folder = tmp_path / "raw"
    write(folder, "a.csv", ["id,v", "1,2", "2,3"])
    found = I.infer(spark, str(folder))
    declared = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.DoubleType())])
    assert [(r.column_name, r.status) for r in I.drift(spark, found, declared).collect()] == [("id", "same"), ("v", "narrower")]
    other = T.StructType([T.StructField("id", T.DateType()), T.StructField("v", T.LongType())])
    assert [(r.status, r.rejected) for r in I.drift(spark, found, other).collect()] == [("changed", 2), ("narrower", 0)]


def test_no_files_and_bad_headers(spark, tmp_path):
    folder = tmp_path / "raw"
    write(folder, "a.csv", [])
    found = I.infer(spark, str(folder))
    assert found.columns == () and I.read_inferred(spark, found).count() == 0
    write(tmp_path / "twice", "a.csv", ["a,a", "1,2"])
    with pytest.raises(ValueError):
        I.infer(spark, str(tmp_path / "twice"))


def test_big_files_are_split(spark, tmp_path):
    """The header of a file of many splits is its first line."""
    rnd, folder = random.Random(1), tmp_path / "raw"
    write(folder, "a.csv", ["k,v"] + [f"{rnd.randint(0, 10 ** 9)},{rnd.random()}" for _ in range(50_000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        found = I.infer(spark, str(folder))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [v.header for v in found.variants] == [("k", "v")]
    assert [(c.kind, sum(c.counts.values())) for c in found.columns] == [("integer", 50_000), ("double", 50_000)]
