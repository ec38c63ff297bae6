"""Plain-parquet tables whose columns change from version to version.

Each version of a table is a folder with a schema record (``_schemas/v-0007``: the
columns with their types, created atomically). Readers get all versions, or a range
of them, in the schema of the newest: columns that a version lacks are NULL, types
that were widened (``WIDER``) are cast, renamed or dropped ones are not read. A
new version whose types contradict the present ones is refused before it is
written; ``replace=True`` starts a new lineage instead (a schema-replacing
overwrite): versions before it are no longer read together with it.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import manifests, writers

SCHEMAS, VERSION = "_schemas", "v-"
# what a column of a type may become; each cast keeps every value
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"), "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"), "float": ("double",), "date": ("timestamp_ntz",), "void": ("*",),
}


class SchemaConflict(ValueError):
    """A column's new type can not hold its old values."""


def widens(old: str, new: str) -> bool:
    return old == new or new in WIDER.get(old, ()) or "*" in WIDER.get(old, ())


def conflicts(old: T.StructType, new: T.StructType) -> list[str]:
    """Columns of both schemas whose types can not be reconciled."""
    before = {f.name: f.dataType.simpleString() for f in old.fields}
    return [f"{f.name}: {before[f.name]} -> {f.dataType.simpleString()}" for f in new.fields
            if f.name in before and not widens(before[f.name], f.dataType.simpleString())
            and not widens(f.dataType.simpleString(), before[f.name])]


def reconciled(old: T.StructType, new: T.StructType) -> T.StructType:
    """The schema that holds both: old columns in place, widened where the new
    ones are wider, added ones behind; SchemaConflict if there is none."""
    found = conflicts(old, new)
    if found:
        raise SchemaConflict("; ".join(found))
    after = {f.name: f.dataType for f in new.fields}
    fields = []
    for f in old.fields:
        t = after.get(f.name, f.dataType)
        fields.append(T.StructField(f.name, t if widens(f.dataType.simpleString(), t.simpleString()) else f.dataType))
    fields += [T.StructField(f.name, f.dataType) for f in new.fields if f.name not in old.names]
    return T.StructType(fields)


class EvolvingTable:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def versions(self) -> list[dict]:
        """The committed records, in order."""
        return [json.loads(text) for _, text in manifests.read_text(self.spark, f"{self.folder}/{SCHEMAS}", VERSION)]

    def _lineage(self, records: list[dict]) -> list[dict]:
        """The versions since the last replacement."""
        start = max((i for i, r in enumerate(records) if r["replace"]), default=0)
        return records[start:]

    def schema(self) -> T.StructType | None:
        """The table's present schema."""
        records = self.versions()
        return T.StructType.fromJson(records[-1]["table"]) if records else None

    def write(self, df: DataFrame, replace: bool = False) -> int:
        """Add a version; returns its number."""
        records = self.versions()
        number = len(records)
        table = df.schema
        if records and not replace:
            table = reconciled(self.schema(), df.schema)
        path = f"{VERSION}{number:08d}-data"
        writers.write_overwrite(df, os.path.join(self.folder, path))
        record = {"path": path, "own": json.loads(df.schema.json()), "table": json.loads(table.json()), "replace": replace or not records}
        if not manifests.write_once(self.spark, f"{self.folder}/{SCHEMAS}/{VERSION}{number:08d}", json.dumps(record)):
            raise RuntimeError(f"{self.folder}: another writer has added version {number}")
        return number

    def read(self, version: int | None = None) -> DataFrame:
        """One version's rows (the last by default) in the table's present schema."""
        records = self.versions()
        return self._read(records[-1 if version is None else version], self.schema())

    def read_all(self, number_column: str | None = None) -> DataFrame:
        """The rows of all versions since the last replacement."""
        records, out = self.versions(), None
        for r in self._lineage(records):
            part = self._read(r, self.schema())
            if number_column:
                part = part.withColumn(number_column, F.lit(records.index(r)))
            out = part if out is None else out.unionByName(part)
        return out

    def _read(self, record: dict, schema: T.StructType) -> DataFrame:
        own = T.StructType.fromJson(record["own"])
        df = self.spark.read.schema(own).parquet(os.path.join(self.folder, record["path"]))
        cols = []
        for f in schema.fields:
            known = f.name in own.names and widens(own[f.name].dataType.simpleString(), f.dataType.simpleString())
            cols.append((F.col(f"`{f.name}`") if known else F.lit(None)).cast(f.dataType).alias(f.name))
        return df.select(*cols)

    def changes(self) -> DataFrame:
        """(version, column_name, change, old_type, new_type): what each version
        has changed: added, widened, absent (in the table, not in this version)."""
        rows, before = [], None
        for i, r in enumerate(self.versions()):
            own, table = T.StructType.fromJson(r["own"]), T.StructType.fromJson(r["table"])
            if before is not None and not r["replace"]:
                for f in table.fields:
                    new = f.dataType.simpleString()
                    if f.name not in before.names:
                        rows.append((i, f.name, "added", None, new))
                    elif before[f.name].dataType != f.dataType:
                        rows.append((i, f.name, "widened", before[f.name].dataType.simpleString(), new))
                    elif f.name not in own.names:
                        rows.append((i, f.name, "absent", new, None))
            elif r["replace"] and before is not None:
                rows.append((i, None, "replaced", None, None))
            before = table
        return self.spark.createDataFrame(rows, "version int, column_name string, change string, old_type string, new_type string")
