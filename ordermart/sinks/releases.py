"""One switch for a whole set of tables.

``publish_release`` writes a new version folder of each table, then creates one
manifest file (``_releases/run-00000007``) that names the version of every table of
the set. Readers (``Release``) take the highest manifest, so they see all tables of
one run or all of the run before, also when a publisher dies between any two writes.
Tables that a run does not write keep their version. A manifest is created
atomically; of two publishers of one number, the second takes the next number and
adds its tables to what the first has published.

With ``database``, views follow after the switch, one statement each: a reader of
several views during a publish may see two runs; ``Release`` never does.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path
from ..sources import raw
from . import manifests, writers

RUNS, RUN = "_releases", "run-"
KEEP_RUNS = 3


@dataclass(frozen=True)
class Release:
    """One complete set: version folder and text partition columns by table."""

    spark: SparkSession
    root: str
    tables: dict[str, dict]

    def path(self, name: str) -> str:
        return os.path.join(self.root, name, self.tables[name]["version"])

    def read(self, name: str) -> DataFrame:
        return raw.read_path(self.spark, self.path(name), self.tables[name]["format"], self.tables[name]["partitions"])


def _runs(root: str) -> str:
    return os.path.join(root, RUNS)


def current_release(spark: SparkSession, root: str) -> Release:
    """The set that is published now; FileNotFoundError before the first."""
    return Release(spark, root, json.loads(manifests.latest(spark, _runs(root), RUN)))


def _carried(spark: SparkSession, root: str) -> dict:
    return current_release(spark, root).tables if manifests.names(spark, _runs(root), RUN) else {}


def publish_release(spark: SparkSession, tables: Mapping[str, DataFrame | Callable[[], DataFrame]], root: str,
                    partition_cols: Mapping[str, Sequence[str]] | None = None, database: str | None = None,
                    fmt: str = "parquet", parallelism: int = 1, keep: int = KEEP_RUNS) -> Release:
    """Publish a set below ``root`` and return it. A table may be a builder, as in
    ``writers.publish``."""
    version, by = f"v-{uuid.uuid4().hex[:12]}", partition_cols or {}
    built: dict[str, DataFrame] = {}

    def one(name: str) -> None:
        spec, path = tables[name], os.path.join(root, name, version)
        built[name] = df = spec() if callable(spec) else spec
        if by.get(name):
            writers.write_partitioned(df, path, by[name], fmt)
        else:
            writers.write_overwrite(df, path, fmt)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for job in [pool.submit(copy_context().run, one, n) for n in tables]:
            job.result()
    mine = {n: {"version": version, "format": fmt, "partitions": list(by.get(n, ()))} for n in tables}
    release = _switch(spark, root, mine)
    if database:
        writers.ensure_database(spark, database)
        for name, df in built.items():
            writers.point_view(df, f"{database}.{name}", release.path(name), version, fmt, by.get(name, ()))
    clean(spark, root, keep)
    return release


def _switch(spark: SparkSession, root: str, mine: dict) -> Release:
    while True:
        found = manifests.names(spark, _runs(root), RUN)
        number = int(found[-1].removeprefix(RUN)) + 1 if found else 0
        tables = {**_carried(spark, root), **mine}
        if manifests.write_once(spark, os.path.join(_runs(root), f"{RUN}{number:08d}"), json.dumps(tables)):
            return Release(spark, root, tables)


def clean(spark: SparkSession, root: str, keep: int = KEEP_RUNS) -> None:
    """Delete what only older manifests than the last ``keep`` name: first the
    manifests, then their version folders. Folders that no manifest names may
    belong to a run that is still writing; they are left alone."""
    found = manifests.read_text(spark, _runs(root), RUN)
    kept = {(n, t["version"]) for _, text in found[-keep:] for n, t in json.loads(text).items()}
    gone = {(n, t["version"]) for _, text in found[:-keep] for n, t in json.loads(text).items()} - kept
    for name, _ in found[:-keep]:
        delete_path(spark, os.path.join(_runs(root), name))
    for table, version in sorted(gone):
        delete_path(spark, os.path.join(root, table, version))
