"""The end-to-end run: bronze -> silver -> gold, one callable for any scheduler.

Layers are written once and each next layer reads the STORED previous one, so
nothing upstream is recomputed per mart (the original job re-ran silver for every
display and for each of two writes). The stages are separate functions so a
scheduler (or the bench) can run and time them one by one.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.sql import DataFrame, SparkSession

from ..functions.calendar import month_label
from ..operators import marts, quality
from ..operators import silver as S
from ..operators.skew_join import SALT_ROWS
from ..session import staging
from ..sinks import releases, writers
from ..sources import bronze, raw

SILVER_PARTITION = "delivery_city"
# Optional layout column of bronze orders. By default bronze is written
# unpartitioned: the ingest is then map-only (scan -> audit columns -> write,
# no shuffle of the raw table), and no query prunes on a bronze partition.
# ``"order_month"`` (derived) gives month folders; day folders (the order date
# itself) give thousands of tiny files at small volumes.
BRONZE_ORDERS_PARTITION = "order_month"


def persist_silver(silver: DataFrame, path: str, partition_col: str = SILVER_PARTITION,
                   fmt: str = "parquet") -> DataFrame:
    """Write silver partitioned (rebalanced) and return the stored copy."""
    writers.write_partitioned(silver, path, [partition_col], fmt=fmt)
    return raw.read_path(silver.sparkSession, path, fmt, [partition_col])


def read_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored silver; its city folders are text, whatever they look like."""
    return raw.read_path(spark, path, fmt, [SILVER_PARTITION])


def ingest_bronze(spark: SparkSession, sources: Mapping[str, str], target: str, now=None,
                  fmt: str = "parquet", schemas=None, orders_partition: str | None = None,
                  database: str | None = None) -> dict[str, str]:
    """Raw CSVs -> bronze tables (raw columns + audit columns), written once,
    as new versions (``writers.publish_folder``).

    ``orders_partition`` ("order_month" or "order_date") lays bronze orders
    out in folders (rebalanced, so a busy month is still written by many
    tasks); this costs a shuffle of the raw table.
    """
    ingested = bronze.ingest_all(spark, sources, now, schemas)

    def one(name: str) -> str:
        df = ingested[name]
        parts = [orders_partition] if name == "orders" and orders_partition else []
        if parts == [BRONZE_ORDERS_PARTITION]:
            df = df.withColumn(BRONZE_ORDERS_PARTITION, month_label("order_date"))
        return writers.publish_folder(df, os.path.join(target, "bronze", name),
                                      f"{database}.bronze_{name}" if database else None,
                                      fmt, parts)

    # the four ingests are independent map-only jobs: submit them concurrently
    with ThreadPoolExecutor(max_workers=len(ingested) or 1) as pool:
        jobs = {n: pool.submit(copy_context().run, one, n) for n in ingested}
        return {n: j.result() for n, j in jobs.items()}


def build_silver_layer(spark: SparkSession, bronze_paths: Mapping[str, str], target: str,
                       now=None, fmt: str = "parquet", broadcast_dims: bool = False,
                       database: str | None = None, **clean_kw) -> dict[str, object]:
    """Stored bronze -> silver_orders (partitioned) + quarantine_orders, as new
    versions.

    Also returns ``dq_summary`` (lazy), computed over the STAGED classified
    orders, so it does not re-run the dedup.
    """
    b = {n: raw.read_path(spark, p, fmt) for n, p in bronze_paths.items()}
    b["orders"] = b["orders"].drop(BRONZE_ORDERS_PARTITION)  # layout column, if any
    clean_kw.setdefault("salt_rows", SALT_ROWS)
    parts = S.build_silver_parts(b["orders"], b["customers"], b["restaurants"],
                                 b["partners"], now=now, broadcast_dims=broadcast_dims,
                                 **clean_kw)
    tables = {"silver_orders": ("orders", parts["silver"], [SILVER_PARTITION]),
              "quarantine_orders": ("quarantine", parts["quarantine"], [])}

    def one(name: str) -> str:
        folder, df, by = tables[name]
        return writers.publish_folder(df, os.path.join(target, "silver", folder),
                                      f"{database}.{name}" if database else None, fmt, by)

    # independent writes over the staged orders: run them as concurrent jobs
    with ThreadPoolExecutor(max_workers=2) as pool:
        jobs = {n: pool.submit(copy_context().run, one, n) for n in tables}
        paths = {n: j.result() for n, j in jobs.items()}
    return {**paths, "dq_summary": quality.summary(parts["flagged"])}


def gold_marts(spark: SparkSession, silver_path: str, as_of=None,
               fmt: str = "parquet") -> dict[str, DataFrame]:
    """The twelve marts over the STORED silver (lazy)."""
    return marts.all_marts(read_silver(spark, silver_path, fmt), as_of)


def gold_builders(spark: SparkSession, silver_path: str, as_of=None,
                  fmt: str = "parquet") -> dict[str, Callable[[], DataFrame]]:
    """Zero-argument builders of the twelve marts (for concurrent publishing:
    the rank marts run their staging jobs while being built)."""
    silver = read_silver(spark, silver_path, fmt)
    return {name: (lambda b=b: b(silver, as_of)) for name, b in marts.MART_FUNCTIONS.items()}


def run(spark: SparkSession, sources: Mapping[str, str], target: str, as_of=None, now=None,
        database: str | None = None, fmt: str = "parquet",
        broadcast_dims: bool = False, release: bool = True,
        gold_parallelism: int = 4) -> dict[str, object]:
    """Ingest the four raw CSVs, build silver + quarantine, publish the 12 marts.

    ``sources`` maps ``orders``/``customers``/``restaurants``/``partners`` to CSV
    paths. ``as_of`` (recency) and ``now`` (audit / load times) default to the
    clock. Every table is a new version below ``target``, switched to when it is
    complete (the twelve marts together, by one manifest: ``releases``); with
    ``database``, bronze, silver, quarantine and gold are catalog entries too. The DQ summary is a small table next to silver; the marts are
    published by ``gold_parallelism`` concurrent jobs. Intermediates are staged
    under ``target`` and (with ``release``) deleted at the end, also when the
    run fails. Returns the written paths plus the DQ summary and the table
    manifest (lazy reads of the written tables).
    """
    if database:
        writers.ensure_database(spark, database, os.path.join(target, "_catalog"))
    with staging(spark, target, release):
        bronze_paths = ingest_bronze(spark, sources, target, now, fmt, database=database)
        silver_out = build_silver_layer(spark, bronze_paths, target, now, fmt, broadcast_dims,
                                        database)
        silver_paths = {k: silver_out[k] for k in ("silver_orders", "quarantine_orders")}
        dq_path = writers.publish_folder(silver_out["dq_summary"].coalesce(1),
                                         os.path.join(target, "silver", "dq_summary"), fmt=fmt)
        gold = gold_builders(spark, silver_paths["silver_orders"], as_of, fmt)
        release = releases.publish_release(spark, gold, os.path.join(target, "gold"), database=database,
                                           fmt=fmt, parallelism=gold_parallelism)
        gold_paths = {n: release.path(n) for n in gold}

    read = lambda p: raw.read_path(spark, p, fmt)
    return {
        "bronze": bronze_paths,
        **silver_paths,
        "gold": gold_paths,
        "dq_summary": read(dq_path),
        "manifest": writers.manifest({
            **{f"bronze_{n}": read(p) for n, p in bronze_paths.items()},
            **{n: read(p) for n, p in silver_paths.items()},
            **{n: read(p) for n, p in gold_paths.items()},
        }),
    }
