"""Small text files that commit a state: created once, atomically, never changed.

A numbered series (``run-000007``) gives readers the present state as its highest
number, with no moment at which a pointer is missing: the next file exists wholly or
not at all. A file is written under a name of its own and then renamed without
overwriting, which is atomic on HDFS-like and local file systems; of two writers of
one number, one gets False.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text``, complete or not at all; False if it exists."""
    folder, name = os.path.split(path)
    tmp, fs = _file_system(spark, os.path.join(folder, f".{name}-{uuid.uuid4().hex}"))
    to, _ = _file_system(spark, path)
    fs.mkdirs(to.getParent())
    if fs.exists(to):
        return False
    out = fs.create(tmp, False)
    out.write(bytearray(text.encode()))
    out.close()
    made = _rename_new(spark, tmp, to)
    if not made:
        fs.delete(tmp, False)
    return made


def _rename_new(spark: SparkSession, tmp, to) -> bool:
    """Rename that fails where the target exists."""
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(tmp.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) \
        if tmp.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(tmp, to, none)
    except Exception as e:  # noqa: BLE001 (py4j wraps the Java error)
        if "FileAlreadyExists" in str(e):
            return False
        raise
    return True


def names(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Names of the committed files with a prefix, ascending."""
    p, fs = _file_system(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile() and s.getPath().getName().startswith(prefix))


def folders(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Names of the folders with a prefix, ascending."""
    p, fs = _file_system(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith(prefix))


def latest(spark: SparkSession, folder: str, prefix: str) -> str:
    """Text of the highest file of a series. A file that is cleaned away between
    the listing and the reading has a successor: list again."""
    while True:
        found = names(spark, folder, prefix)
        if not found:
            raise FileNotFoundError(f"{folder}: nothing is published")
        try:
            return read(spark, os.path.join(folder, found[-1]))
        except Exception as e:  # noqa: BLE001 (py4j wraps the Java error)
            if "FileNotFound" not in str(e):
                raise


def read(spark: SparkSession, path: str) -> str:
    p, fs = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def read_text(spark: SparkSession, folder: str, prefix: str) -> list[tuple[str, str]]:
    """(name, text) of all files with a prefix, ascending by name."""
    return [(n, read(spark, os.path.join(folder, n))) for n in names(spark, folder, prefix)]
