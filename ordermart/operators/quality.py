"""Data-quality classification, quarantine split, summary and orphan checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..schemas import CORRUPT_COL

_OPS = {
    "<=": lambda c, v: c <= v,
    "<": lambda c, v: c < v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
}


def dq_flag_expr(null_policy: str = "pass") -> Column:
    """First-match ``CASE`` over the rule list.

    ``null_policy="pass"`` keeps the pipeline's semantics: a NULL operand makes
    its rule UNKNOWN, so the row falls through to later rules and finally OK.
    ``"flag"`` adds a ``NULL_<column>`` flag ahead of the rules instead.
    """
    expr = None

    def add(cond: Column, label: str) -> None:
        nonlocal expr
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))

    if null_policy == "flag":
        for col in ("order_amount", "final_amount", "delivery_time_minutes", "rating",
                    "order_status"):
            add(F.col(col).isNull(), f"NULL_{col.upper()}")
    elif null_policy != "pass":
        raise ValueError(f"unknown null_policy {null_policy!r}")
    for label, col, op, bound in rules.DQ_RULES:
        add(_OPS[op](F.col(col), F.lit(bound)), label)
    add(~F.col("order_status").isin(*rules.VALID_STATUSES), rules.UNKNOWN_STATUS_FLAG)
    return expr.otherwise(F.lit(rules.OK_FLAG))


def classify(orders: DataFrame, null_policy: str = "pass") -> DataFrame:
    """Adds ``dq_flag`` (narrow projection, no shuffle)."""
    return orders.withColumn("dq_flag", dq_flag_expr(null_policy))


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows without ``dq_flag``, quarantined rows with it)."""
    ok = F.col("dq_flag") == rules.OK_FLAG
    return flagged.filter(ok).drop("dq_flag", CORRUPT_COL), flagged.filter(~ok)


def summary(flagged: DataFrame, per_flag: Sequence[str] | None = None) -> DataFrame:
    """Tall (metric, value) table from ONE aggregate pass.

    total / valid / quarantine record counts, then one row per flag. Replaces
    separate ``count()`` actions and a driver-built DataFrame.
    """
    flags = list(per_flag) if per_flag is not None else (
        [r[0] for r in rules.DQ_RULES] + [rules.UNKNOWN_STATUS_FLAG]
        + ([rules.MALFORMED_FLAG] if CORRUPT_COL in flagged.columns else []))
    ok = F.col("dq_flag") == rules.OK_FLAG
    aggs = [F.count(F.lit(1)).alias("total_records"),
            F.count_if(ok).alias("valid_records"),
            F.count_if(~ok).alias("quarantine_records")]
    aggs += [F.count_if(F.col("dq_flag") == f).alias(f) for f in flags]
    wide = flagged.agg(*aggs)
    names = ["total_records", "valid_records", "quarantine_records"] + flags
    return wide.unpivot([], names, "metric", "value")


def orphans(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per dimension: fact rows (and distinct keys) with no dimension row.

    ``dims`` maps a name to (dimension DataFrame, key column). NULL keys are not
    orphans (they never join). One ``left_anti`` join per dimension; Spark picks
    broadcast or shuffle by the dimension's size.
    """
    parts = []
    for name, (dim, key) in dims.items():
        missing = (fact.select(key).filter(F.col(key).isNotNull())
                   .join(dim.select(key), key, "left_anti"))
        parts.append(missing.agg(F.count(F.lit(1)).alias("orphan_orders"),
                                 F.countDistinct(key).alias("orphan_keys"))
                     .select(F.lit(name).alias("dimension"), "orphan_orders", "orphan_keys"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_keys(dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per dimension: keys that occur more than once, and their extra rows
    (each would multiply the fact rows it joins to). One aggregate each."""
    parts = []
    for name, (dim, key) in dims.items():
        dup = (dim.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
               .agg(F.count(F.lit(1)).alias("duplicate_keys"),
                    F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("extra_rows")))
        parts.append(dup.select(F.lit(name).alias("dimension"), "duplicate_keys", "extra_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
