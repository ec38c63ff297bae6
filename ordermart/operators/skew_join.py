"""Left joins of a fact to a dimension that one key can not slow down.

A dimension within the session's broadcast threshold (by Spark's estimate, else
measured in bytes by one pass over it) is broadcast: no key matters then. A larger
one is joined by shuffle on (key, salt):

* a key with more than ``salt_rows`` fact rows gets one salt for each
  ``salt_rows`` of them; its fact rows are dealt over the salts by a hash of a
  spreading column, its dimension rows are copied to each;
* rows without a key match nothing: they get salts of their own, so they are
  dealt over all tasks instead of one, and the dimension has no rows for them;
* all other keys have the one salt 0.

The copies are bounded: at most fact rows / ``salt_rows`` in all, and the table of
heavy keys holds no more than ``MAX_SALTED`` rows (the most frequent ones; a key
beyond these has under 1 / ``MAX_SALTED`` of all rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT_ROWS = 1_000_000
MAX_SALTED = 10_000
ROW_BYTES = 16  # a row's own cost in a hash table, beside its values
NULL_SALTS_A_TASK = 4


def data_bytes(df: DataFrame) -> int:
    """Bytes of all values (8 for each that is not text) and rows; one pass."""
    size = F.lit(ROW_BYTES)
    for f in df.schema.fields:
        text = isinstance(f.dataType, (T.StringType, T.BinaryType))
        size = size + (F.coalesce(F.octet_length(f.name), F.lit(0)) + 8 if text else F.lit(8))
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def broadcast_threshold(df: DataFrame) -> int:
    """The session's ``autoBroadcastJoinThreshold`` in bytes (-1: off)."""
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate (file metadata; no job)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def heavy_counts(df: DataFrame, key: str, above: int, max_keys: int = MAX_SALTED) -> dict:
    """Keys with more than ``above`` rows, the most frequent ``max_keys`` of them
    (map-side pre-aggregated, bounded top-k)."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.filter(F.col("_n") > above).orderBy(F.desc("_n"), key).limit(max_keys)
    return {r[0]: r["_n"] for r in best.collect()}


def left_join(fact: DataFrame, dim: DataFrame, key: str, spread: Sequence[str],
              salt_rows: int = SALT_ROWS, counts_from: DataFrame | None = None) -> DataFrame:
    """``fact.join(dim, key, "left")``, salted where the dimension is too large to
    broadcast. ``spread``: columns that tell fact rows apart; ``counts_from``: a
    cheaper table with the fact's keys (its stored form), to count them."""
    limit = broadcast_threshold(dim)
    if estimated_bytes(dim) <= limit:
        return fact.join(dim, key, "left")  # Spark plans a broadcast from the same estimate
    if data_bytes(dim) <= limit:
        return fact.join(F.broadcast(dim), key, "left")
    heavy = heavy_counts(fact if counts_from is None else counts_from, key, salt_rows)
    return salted_left_join(fact, dim, key, spread, {k: -(-n // salt_rows) for k, n in heavy.items()})


def salted_left_join(fact: DataFrame, dim: DataFrame, key: str, spread: Sequence[str], salts: dict) -> DataFrame:
    """The join with ``salts[key]`` salts for each heavy key."""
    spark = fact.sparkSession
    lost = NULL_SALTS_A_TASK * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    schema = T.StructType([T.StructField("_k", fact.schema[key].dataType), T.StructField("_salts", T.IntegerType())])
    table = F.broadcast(spark.createDataFrame(list(salts.items()), schema))
    many = F.when(F.col(key).isNull(), F.lit(lost)).otherwise(F.coalesce("_salts", F.lit(1)))
    left = (fact.join(table, F.col(key) == F.col("_k"), "left")
            .withColumn("_salt", F.pmod(F.xxhash64(*spread), many).cast("int")).drop("_k", "_salts"))
    right = (dim.filter(F.col(key).isNotNull()).join(table, F.col(key) == F.col("_k"), "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
             .drop("_k", "_salts"))
    return left.join(right, [key, "_salt"], "left").drop("_salt")
