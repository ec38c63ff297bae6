"""Shared helpers of the llm operators: shared scratch folder, staging, tables.

Staged tables go below ``spark.checkpoint.dir`` (a folder that the driver and
all executors share), so a lost executor costs a re-read and no lineage grows.
Only a local session without that setting gets a private temporary folder.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder that the driver and all executors see (no trailing slash)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_staged: list[str] = []


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder (not created yet)."""
    path = f"{shared_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return it reread."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_mark() -> int:
    """Position in the list of staged folders; pass it to ``release``."""
    return len(_staged)


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the folders staged after a mark, but the last ``keep``. Call it
    when no DataFrame that reads them is needed any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = _staged[since:len(_staged) - keep]
    del _staged[since:len(_staged) - keep]
    for path in gone:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def unused_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have (compared as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def trim_worker() -> None:
    """Give a worker's unused memory back to the system: Spark reuses Python
    workers, and what one task has freed would else count for all later ones."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per context): they need
    not share the driver's import path."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    to = Path(tempfile.mkdtemp(prefix="llm-ship-")) / "package.zip"
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(to))
    sc._llm_shipped = True
