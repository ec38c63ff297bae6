"""Global ranking without a single-partition window.

``Window.orderBy(...)`` with no partition key makes Spark move every row into
ONE task (``Exchange SinglePartition``). The operators here compute the same
numbers with the work spread over many tasks:

1. **Range shuffle.** The rows are range-partitioned by the order (Spark samples
   the bounds), sorted inside each partition and written once, each with its
   partition and its place in it. Both are stored, so no later pass can see
   another placement, and no row is compared with bounds again.
2. **Offsets.** Rows per partition are counted on the stored copy (one small
   scan of one column); their running sum is a literal array with one entry a
   partition. The global row number is an addition.
3. **Buckets.** Where a bounded piece of the order is needed (windows over hot keys),
   a bucket is a run of the row numbers: ``(rn - 1) * buckets div rows``, exactly
   even, whatever the number of tasks; more buckets cost nothing.

Size check: an input of at most ``SMALL_RANK_ROWS`` rows (counted first; a
metadata-cheap count on the staged inputs the marts pass in) is ranked with
the plain window instead: one task holding a proven-bounded number of rows is
cheaper than the extra write and count jobs. Beyond the bound, always the
range shuffle (like a broadcast join behind a size check, with the shuffle
join beyond it). ``small_rows=0`` forces it (tests).

Ties: ``row_number``-based operators require a total order (callers append a
unique tiebreak column), so a heavy key value is spread over many partitions.
``dense_rank`` works on the DISTINCT values, so duplicates collapse in the
map-side partial aggregate before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

OrderSpec = Sequence[tuple[str, bool]]  # (column, descending)

SMALL_RANK_ROWS = 200_000
MIN_ROWS_PER_BUCKET = 20_000
_PLACE_BITS = 33  # of monotonically_increasing_id; above them is the partition


def default_buckets(df: DataFrame, rows: int | None = None) -> int:
    """About four buckets per shuffle partition, and no more than one per
    ``MIN_ROWS_PER_BUCKET`` rows (tiny buckets only add overhead)."""
    b = 4 * _partitions(df)
    if rows is not None:
        b = min(b, -(-rows // MIN_ROWS_PER_BUCKET))
    return max(2, b)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def ordered(df: DataFrame, order: OrderSpec, out: str = "_rn", ranges: int | None = None,
            name: str = "ordered") -> tuple[DataFrame, int]:
    """The stored rows of ``df`` with their row number in ``order``, and how many
    there are. One range shuffle and one write; ``df`` is read twice (the sample of
    the bounds and the shuffle), so an expensive plan is staged first."""
    keys = window_order(order)
    laid = (df.repartitionByRange(ranges or _partitions(df), *keys).sortWithinPartitions(*keys)
            .withColumn("_at", F.monotonically_increasing_id()))
    stored = materialize(laid, name)
    part = F.shiftright("_at", _PLACE_BITS).cast("int")
    counts = {r["p"]: r["n"] for r in stored.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = [], 0
    for i in range(max(counts, default=0) + 1):
        offsets.append(total)
        total += counts.get(i, 0)
    before = F.array(*[F.lit(o).cast("long") for o in offsets])
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return stored.withColumn(out, F.get(before, part) + place + 1).drop("_at"), total


def window_order(order: OrderSpec) -> list[Column]:
    """Spark's default null placement: ASC NULLS FIRST, DESC NULLS LAST."""
    return [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_first() for c, d in order]


def with_buckets(df: DataFrame, order: OrderSpec, bucket_col: str = "_bkt",
                 buckets: int | None = None, name: str = "buckets") -> DataFrame:
    """The stored rows of ``df`` with the bucket of each: runs of ``order`` of
    equal size, numbered from 0."""
    rows = None if buckets else df.count()
    n = buckets or default_buckets(df, rows)
    numbered, total = ordered(df, order, ranges=min(n, _partitions(df)), name=name)
    bucket = F.floor((F.col("_rn") - 1) * F.lit(n) / F.lit(max(1, total)))
    if total * n >= 2 ** 53:  # beyond exact doubles
        bucket = F.expr(f"CAST((_rn - 1) AS DECIMAL(38, 0)) * {n} div {total}")
    return numbered.withColumn(bucket_col, bucket.cast("int")).drop("_rn")


def _small(df: DataFrame, small_rows: int, rows: int | None = None) -> int | None:
    """Row count (``rows`` when known) when it is within ``small_rows``, else None."""
    if small_rows <= 0:
        return None
    n = df.count() if rows is None else rows
    return n if n <= small_rows else None


def global_row_number(df: DataFrame, order: OrderSpec, out: str = "row_number",
                      total_col: str | None = None, buckets: int | None = None,
                      small_rows: int = SMALL_RANK_ROWS, rows: int | None = None) -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` computed range-parallel.

    ``rows``: the input's row count when already known. ``order`` must be a total
    order (end it with a unique column) for the result to be deterministic.
    ``buckets``: the number of ranges, at most one a shuffle partition. Optionally
    adds the total row count as ``total_col``.
    """
    n = _small(df, small_rows, rows)
    if n is not None:
        out_df = df.withColumn(out, F.row_number().over(
            Window.orderBy(*window_order(order))).cast("long"))
    else:
        ranges = min(_partitions(df), buckets or default_buckets(df, rows))
        out_df, n = ordered(df, order, out, ranges, "row-numbers")
    return out_df.withColumn(total_col, F.lit(n).cast("long")) if total_col else out_df


def global_dense_rank(df: DataFrame, value: str, descending: bool = True,
                      out: str = "dense_rank", buckets: int | None = None,
                      small_rows: int = SMALL_RANK_ROWS) -> DataFrame:
    """``dense_rank() OVER (ORDER BY value [DESC])`` on distinct values.

    Duplicates collapse in the partial aggregate of ``distinct()``; the ranked
    distinct values are joined back null-safely (a NULL value ranks last for
    DESC, first for ASC, as in Spark).
    """
    if _small(df, small_rows) is not None:
        return df.withColumn(out, F.dense_rank().over(
            Window.orderBy(*window_order([(value, descending)]))).cast("int"))
    vals = materialize(df.select(value).distinct(), "rank-values")
    ranked = global_row_number(vals, [(value, descending)], out=out, buckets=buckets,
                               small_rows=0) \
        .withColumnRenamed(value, "_v")
    joined = df.join(ranked, df[value].eqNullSafe(ranked["_v"]), "inner").drop("_v")
    return joined.withColumn(out, F.col(out).cast("int"))


def ntile_from_row_number(rn: Column, total: Column, n: int) -> Column:
    """Closed-form ``ntile(n)`` from a 1-based row number and the row count.

    The first ``total % n`` tiles hold one row more than the others.
    """
    q = F.floor(total / F.lit(n)).cast("long")
    r = (total % F.lit(n)).cast("long")
    big = r * (q + 1)
    first = F.floor((rn - 1) / (q + 1)) + 1
    rest = r + F.floor((rn - big - 1) / F.greatest(q, F.lit(1))) + 1
    return F.when(rn <= big, first).otherwise(rest).cast("int")


def global_ntile(df: DataFrame, n: int, order: OrderSpec, out: str = "ntile",
                 buckets: int | None = None, small_rows: int = SMALL_RANK_ROWS,
                 rows: int | None = None) -> DataFrame:
    """``ntile(n) OVER (ORDER BY order)`` with a total order, bucket-parallel.
    ``rows``: the input's row count when already known."""
    if _small(df, small_rows, rows) is not None:
        return df.withColumn(out, F.ntile(n).over(Window.orderBy(*window_order(order))))
    numbered = global_row_number(df, order, out="_rn", total_col="_tot", buckets=buckets,
                                 small_rows=0, rows=rows)
    return numbered.withColumn(out, ntile_from_row_number(F.col("_rn"), F.col("_tot"), n)) \
        .drop("_rn", "_tot")


def top_k_with_ties(df: DataFrame, value: str, k: int, out: str = "rank",
                    descending: bool = True) -> DataFrame:
    """Rows whose ``dense_rank() OVER (ORDER BY value)`` is <= k, with that rank.

    The k best DISTINCT values come from a bounded top-k (each task keeps at
    most k values); the k-row rank table is broadcast and inner-joined, so
    every tied row is kept and nothing funnels through one task.
    """
    # Spark's defaults: DESC puts NULLs last, ASC puts them first
    ordering = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    best = df.select(value).distinct().orderBy(ordering).limit(k)
    ranked = best.select(
        F.col(value).alias("_v"),
        F.row_number().over(Window.orderBy(ordering)).cast("int").alias(out))
    return df.join(F.broadcast(ranked), df[value].eqNullSafe(ranked["_v"]), "inner").drop("_v")


def dense_rank_within(df: DataFrame, part: str, value: str, descending: bool = True,
                      out: str = "dense_rank", buckets: int | None = None,
                      heavy_rows: int | None = None) -> DataFrame:
    """``dense_rank() OVER (PARTITION BY part ORDER BY value)`` without putting
    a whole (possibly huge) partition into one task.

    Works on DISTINCT (part, value) pairs: bucketed by the order
    of (part, value), ranked locally per (bucket, part), then offset by the
    number of distinct values the same ``part`` has in earlier buckets (a
    window over at most ``B`` rows per part). The ranked pairs are joined back
    null-safely on (part, value).
    """
    from .history import HEAVY_ROWS, heavy_keys
    heavy_rows = HEAVY_ROWS if heavy_rows is None else heavy_rows
    plain = Window.partitionBy(part).orderBy(*window_order([(value, descending)]))
    if heavy_rows > 0:
        heavy = heavy_keys(df, part, heavy_rows)
        if heavy == []:
            # every partition is bounded by heavy_rows: the plain window is safe
            return df.withColumn(out, F.dense_rank().over(plain).cast("int"))
    # the pairs are read by the sample, the local ranks and the offsets
    pairs = materialize(df.select(part, value).distinct(), "rank-pairs")
    b = with_buckets(pairs, [(part, False), (value, descending)], buckets=buckets, name="rank-buckets")
    local = b.withColumn("_lr", F.row_number().over(
        Window.partitionBy("_bkt", part).orderBy(*window_order([(value, descending)]))))
    seg = b.groupBy("_bkt", part).agg(F.count(F.lit(1)).alias("_n"))
    prior = Window.partitionBy(part).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.select(F.col("_bkt").alias("_sb"), F.col(part).alias("_sp"),
                     F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_off"))
    ranked = local.join(seg, (local["_bkt"] == seg["_sb"]) & local[part].eqNullSafe(seg["_sp"]))
    ranked = ranked.select(F.col(part).alias("_p"), F.col(value).alias("_v"),
                           (F.col("_off") + F.col("_lr")).cast("int").alias(out))
    cond = df[part].eqNullSafe(ranked["_p"]) & df[value].eqNullSafe(ranked["_v"])
    return df.join(ranked, cond, "inner").drop("_p", "_v")
