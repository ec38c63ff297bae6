"""Session helpers: a local session for tests and staged intermediates.

Library code never creates its own session and never changes its settings.
Intermediates are written below a shared folder: the current run's own one
(``staging``), else the cluster's ``spark.checkpoint.dir``.  Only a local
session with neither uses a folder of its own under the temporary directory;
on a cluster, where executors could not see it, that is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Staging:
    """Folder of one run and what it has staged there."""

    root: str
    paths: list[str] = field(default_factory=list)


_RUN: ContextVar[Staging | None] = ContextVar("ordermart_staging", default=None)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ordermart") -> SparkSession:
    """Session for tests and the bench: local mode, AQE on, UI off, UTC."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables (see the module's text)."""
    run = _RUN.get()
    root = (run.root if run else None) or spark.conf.get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getCheckpointDir()
    if not root:
        sc = spark.sparkContext
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), f"ordermart-{sc.applicationId}")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the scratch root."""
    return os.path.join(scratch_root(spark), "ordermart", f"{name}-{uuid.uuid4().hex}")


_STAGED: list[str] = []


def materialize(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` once to a fresh folder under the shared scratch root and
    return the stored copy.

    Used where one intermediate feeds several passes (a quarantine split, the
    windows and aggregates of the history, the sample/rank/offset passes of a
    global rank): every consumer then scans the stored rows instead of
    re-running the upstream shuffles, and a lost executor costs a re-read,
    not a recomputation. Parquet copies are compressed with zstd: a quarter smaller
    than by default.
    """
    spark, run = df.sparkSession, _RUN.get()
    path = scratch_path(spark, name)
    (run.paths if run else _STAGED).append(path)
    w = df.write.mode("overwrite").format(fmt)
    (w.option("compression", "zstd") if fmt == "parquet" else w).save(path)
    return spark.read.format(fmt).load(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the Hadoop FileSystem of its path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))


@contextmanager
def staging(spark: SparkSession, target: str, release: bool = True) -> Iterator[Staging]:
    """Stage one run's intermediates under ``<target>/_staging/<run>``; they are
    deleted when the run ends, also when it fails. Threads see the run only in
    a copy of the context (``contextvars.copy_context().run``)."""
    run = Staging(os.path.join(target, "_staging", uuid.uuid4().hex))
    token = _RUN.set(run)
    try:
        yield run
    finally:
        _RUN.reset(token)
        if release:
            delete_path(spark, run.root)


def staged_mark() -> int:
    """Position in the log of folders staged outside a run."""
    return len(_STAGED)


def release_staged(spark: SparkSession, since: int = 0) -> int:
    """Delete the folders that ``materialize`` wrote outside a run after mark
    ``since``. Call only when no DataFrame that reads them is still needed."""
    n = 0
    while len(_STAGED) > since:
        n += delete_path(spark, _STAGED.pop())
    return n
