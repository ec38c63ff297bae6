"""Writers: overwrite, partitioned overwrite, catalog tables, publish, manifest.

Parquet overwrite is not atomic and must never target its own input, so a
published table is written to a fresh version folder first. Only when that is
complete do the catalog entry and the pointer of path readers
(``current_path``) move to it; a failing write leaves both on the old version.
Neither move has a gap: the pointer is the highest of a numbered series of files
that are created atomically, the catalog entry a view that one statement
replaces. ``releases`` adds one switch for a whole set of tables.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..schemas import EMPTY_PARTITION
from ..session import delete_path
from . import manifests

CURRENT = "CURRENT-"
KEEP_VERSIONS = 3  # a running reader may hold an older one
KEEP_POINTERS = 20


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet",
                    options: Mapping[str, str] | None = None) -> str:
    w = df.write.mode("overwrite").format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)
    return path


RAW_FILE_ROWS = 500_000


def write_raw_csv(df: DataFrame, path: str, compression: str | None = None) -> str:
    """CSV with header that round-trips values exactly (Spark's CSV writer
    trims surrounding whitespace unless told not to).

    ``compression``: a codec for the files (text shrinks to about a third). A compressed
    file is read by one task, so each then holds at most ``RAW_FILE_ROWS`` rows."""
    w = (df.write.mode("overwrite").option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if compression:
        w = w.option("compression", compression).option("maxRecordsPerFile", RAW_FILE_ROWS)
    w.csv(path)
    return path


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      fmt: str = "parquet", spread_by: Sequence[str] = (),
                      partitions: int | None = None) -> str:
    """Hive-style partitioned overwrite with few, evenly sized files.

    Default: a ``REBALANCE`` hint on the partition columns — one hash shuffle
    whose partitions AQE splits when they exceed
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` (a partition value
    with a third of all rows becomes many tasks and files) and coalesces when
    small. No sampling pass over the input, unlike a range repartition, which
    would evaluate the whole upstream plan once more just to pick bounds.

    ``spread_by``: range-partition on (partition columns, spread_by) instead;
    for sessions with AQE disabled, where the rebalance cannot split.
    """
    if spread_by:
        keys = list(partition_cols) + list(spread_by)
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        laid_out = df.repartitionByRange(n, *keys)
    else:
        laid_out = df.hint("rebalance", *partition_cols)
    text = [c for c in partition_cols if isinstance(df.schema[c].dataType, StringType)]
    laid_out = laid_out.withColumns({
        c: F.when(F.col(c) == "", F.lit(EMPTY_PARTITION)).otherwise(F.col(c)) for c in text})
    laid_out.write.mode("overwrite").format(fmt).partitionBy(*partition_cols).save(path)
    return path


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")


def save_table(df: DataFrame, table: str, path: str, fmt: str = "parquet",
               partition_cols: Sequence[str] = (),
               options: Mapping[str, str] | None = None) -> str:
    """Write ``df`` to ``path`` (a folder that the table does not use yet), then
    point the external catalog table at it (one write, not table + path)."""
    w = df.write.mode("overwrite").format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(path)
    point_table(df, table, path, fmt, partition_cols)
    return table


def point_table(df: DataFrame, table: str, path: str, fmt: str = "parquet",
                partition_cols: Sequence[str] = ()) -> None:
    """Let an external table read the complete data of ``df`` at ``path``.

    An existing table with the same columns only changes its location. With
    other columns (or folders to find anew) its entry is replaced; external
    data is never deleted by that. The columns are named with their types, so
    folder values are not guessed at."""
    spark = df.sparkSession
    fields = [f for f in df.schema.fields if f.name not in partition_cols]
    fields += [df.schema[c] for c in partition_cols]
    if not partition_cols and spark.catalog.tableExists(table):
        if [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in fields]:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)})" if partition_cols else ""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt}{by} LOCATION '{path}'")
    if partition_cols:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int,
                   options: Mapping[str, str] | None = None) -> str:
    """Parquet files dealt over ``buckets`` by the hash of ``keys`` (as a shuffle by these
    keys deals them). Buckets are known to catalog tables only: the files are written as
    an external table whose entry goes at once, and ``read_bucketed`` makes another."""
    table = f"bucketed_{uuid.uuid4().hex}"
    w = df.write.format("parquet").bucketBy(buckets, *keys).option("path", path)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    try:
        w.saveAsTable(table)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    return path


def read_bucketed(spark: SparkSession, folder: str, parts: Sequence[str], columns: str, keys: Sequence[str],
                  buckets: int) -> DataFrame:
    """Some of the parts (sub-folders) that ``write_bucketed`` wrote below ``folder``, with
    ``columns`` as names and types. It is one scan, that reads a bucket of all parts in one
    task: grouping by ``keys`` needs no shuffle. (A union of bucketed scans claims the same,
    but Spark 4.1 puts its columnar batches one after another.)"""
    table, by = f"bucketed_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (recursiveFileLookup 'true') "
              f"CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{folder}'")
    try:
        df = spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    part = F.element_at(F.split("_metadata.file_path", "/"), -2)
    return df.filter(part.isin(*parts)).select(*df.columns)


def point_view(df: DataFrame, name: str, path: str, version: str, fmt: str = "parquet",
               partition_cols: Sequence[str] = (), keep: int = KEEP_VERSIONS) -> None:
    """Let the catalog entry ``name`` read the complete data of ``df`` at ``path``.

    The version gets a table of its own (``<name>__<version>``), complete with its
    partitions; then one statement replaces the view ``name``, whatever its columns
    were. Tables of versions but the last ``keep`` are dropped (their data is
    external)."""
    spark = df.sparkSession
    database, _, short = name.rpartition(".")
    own = f"{short}__{version.replace('-', '_')}"
    prefix = f"{database}." if database else ""
    point_table(df, prefix + own, path, fmt, partition_cols)
    if _is_table(spark, name):  # an entry that was made as a table
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(f'`{c}`' for c in df.columns)} FROM {prefix}{own}")
    old = spark.sql(f"SHOW TABLES{f' IN {database}' if database else ''} LIKE '{short}__v_*'").collect()
    stale = [r["tableName"] for r in old if r["tableName"] != own.lower()]
    made = {t: spark.sql(f"DESCRIBE TABLE EXTENDED {prefix}{t}").filter("col_name = 'Created Time'").first() for t in stale}
    order = sorted(stale, key=lambda t: _created(made[t]["data_type"] if made[t] else ""), reverse=True)
    for t in order[max(0, keep - 1):]:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{t}")


def _created(text: str) -> float:
    try:
        return datetime.strptime(re.sub(r" [A-Z]{3,4} ", " ", text), "%a %b %d %H:%M:%S %Y").timestamp()
    except ValueError:
        return 0.0


def _is_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW"


def set_current(spark: SparkSession, folder: str, version: str, keep: int = KEEP_VERSIONS) -> None:
    """Make ``version`` the current one of a table's folder, and delete versions
    but the last ``keep``. The next number of the series is created atomically;
    a writer that loses a number takes the one after it."""
    number = _next_number(manifests.names(spark, folder, CURRENT))
    while not manifests.write_once(spark, os.path.join(folder, f"{CURRENT}{number:08d}"), version):
        number += 1
    for old in manifests.names(spark, folder, CURRENT)[:-KEEP_POINTERS]:
        delete_path(spark, os.path.join(folder, old))
    named = [manifests.read(spark, os.path.join(folder, n)) for n in manifests.names(spark, folder, CURRENT)]
    for name in manifests.folders(spark, folder, "v-"):
        if name in named and name not in _last(named, keep):
            delete_path(spark, os.path.join(folder, name))


def _next_number(names: Sequence[str]) -> int:
    return int(names[-1].rpartition("-")[2]) + 1 if names else 0


def _last(values: Sequence[str], n: int) -> list[str]:
    """The last ``n`` distinct values."""
    return list(dict.fromkeys(reversed(values)))[:n]


def current_path(spark: SparkSession, folder: str) -> str:
    """Path of a published table's current version."""
    return os.path.join(folder, manifests.latest(spark, folder, CURRENT))


def publish_folder(df: DataFrame, folder: str, table: str | None = None, fmt: str = "parquet",
                   partition_cols: Sequence[str] = (), version: str | None = None) -> str:
    """Publish one table: write a new version folder below ``folder``, then
    switch the catalog entry (if named) and the pointer to it."""
    version = version or f"v-{uuid.uuid4().hex[:12]}"
    path = os.path.join(folder, version)
    try:
        if partition_cols:
            write_partitioned(df, path, partition_cols, fmt)
        else:
            write_overwrite(df, path, fmt, {"overwriteSchema": "true"} if fmt == "delta" else None)
    except Exception:
        delete_path(df.sparkSession, path)
        raise
    if table:
        point_view(df, table, path, version, fmt, partition_cols)
    set_current(df.sparkSession, folder, version)
    return path


def publish(tables: Mapping[str, DataFrame | Callable[[], DataFrame]], root: str,
            database: str | None = None, fmt: str = "parquet",
            parallelism: int = 1) -> dict[str, str]:
    """Publish every table below ``root`` (``publish_folder``); when a database
    is given, also as a catalog table. Returns name -> path.

    A table may be given as a zero-argument builder (marts with global ranks
    run jobs while they are built). ``parallelism > 1`` submits the
    independent writes from a thread pool: Spark runs them as concurrent jobs,
    so the small final stages of one mart overlap with the scans of another.
    """
    version = f"v-{uuid.uuid4().hex[:12]}"

    def one(name: str) -> str:
        spec = tables[name]
        df = spec() if callable(spec) else spec
        return publish_folder(df, os.path.join(root, name),
                              f"{database}.{name}" if database else None, fmt, version=version)

    if parallelism <= 1:
        return {n: one(n) for n in tables}
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        # each job sees the run's staging folder in a copy of the context
        jobs = {n: pool.submit(copy_context().run, one, n) for n in tables}
        return {n: j.result() for n, j in jobs.items()}


def manifest(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for several tables as ONE union of aggregates:
    a single job, scans pruned to no columns."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """``SHOW TABLES IN database`` as a DataFrame (namespace, tableName, isTemporary)."""
    return spark.sql(f"SHOW TABLES IN {database}")
