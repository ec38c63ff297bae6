import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ordermart.functions.money import avg_money, half_up_ratio, pct, sum_money


def _ref(n, d, digits, scale=1, factor=1):
    if d == 0:
        return None
    q = Decimal(factor * n) / Decimal(scale * d)
    return float(q.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def test_half_up_ratio_matches_decimal(spark):
    rnd = random.Random(7)
    data = [(rnd.randint(-10**12, 10**12), rnd.choice([0, 1, 2, 3, 7, 8, 400, -3, 10**6 + 1]))
            for _ in range(400)]
    data += [(1, 2), (-1, 2), (5, 2), (-5, 2), (12345, 1000), (0, 5), (10**12, 3)]
    schema = StructType([StructField("n", LongType()), StructField("d", LongType())])
    df = spark.createDataFrame(data, schema)
    out = df.select("n", "d",
                    half_up_ratio(F.col("n"), F.col("d"), 2).alias("r2"),
                    half_up_ratio(F.col("n"), F.col("d"), 1, num_scale=10).alias("r1"),
                    pct(F.col("n"), F.col("d")).alias("p")).collect()
    for r in out:
        assert r.r2 == _ref(r.n, r.d, 2), r
        assert r.r1 == _ref(r.n, r.d, 1, scale=10), r
        assert r.p == _ref(r.n, r.d, 2, factor=100), r


def test_avg_money_half_cent_rounds_up(spark):
    # 12.34 and 12.35 average to 12.345 exactly: HALF_UP gives 12.35
    df = spark.createDataFrame([(12.34,), (12.35,)], "x double")
    r = df.agg(avg_money("x").alias("a"), sum_money("x").alias("s")).first()
    assert r.a == 12.35 and r.s == 24.69


def test_money_null_and_empty(spark):
    df = spark.createDataFrame([(None,)], "x double")
    r = df.agg(avg_money("x").alias("a"), sum_money("x").alias("s")).first()
    assert r.a is None and r.s is None
    empty = spark.createDataFrame([], "x double")
    r = empty.agg(avg_money("x").alias("a")).first()
    assert r.a is None
