"""Types of delimited text, found in one pass over all values.

``survey`` reads the headers of all files, then folds every value of every
column into counts of the narrowest types that hold them (one aggregate, map-side
partial); ``infer`` decides on these counts. A column's type is the least one that holds all its values, or, with a
``tolerance``, the least one that holds at least that share of them; the others
are its rejects, reported with a bounded number of examples. ``drift`` compares the
result with a declared schema; ``read_inferred`` reads the files with it, whatever
the order of each file's columns.

The order of types (each holds all to its left)::

    null < boolean                    < string
    null < integer < long < double    < string
    null < date < timestamp           < string

Files with the same header are one variant and one scan; columns that a variant
lacks are NULL. An empty field is NULL, as in Spark's CSV reader. A file without
any line has no header and takes no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CORRUPT_COL

BOOLEAN, INTEGER, LONG, DOUBLE, DATE, TIMESTAMP, STRING = KINDS = (
    "boolean", "integer", "long", "double", "date", "timestamp", "string")
SPARK_TYPES: dict[str, T.DataType] = {
    BOOLEAN: T.BooleanType(), INTEGER: T.IntegerType(), LONG: T.LongType(), DOUBLE: T.DoubleType(),
    DATE: T.DateType(), TIMESTAMP: T.TimestampNTZType(), STRING: T.StringType()}
# the narrower kinds that each kind holds too
HOLDS = {BOOLEAN: (BOOLEAN,), INTEGER: (INTEGER,), LONG: (INTEGER, LONG), DOUBLE: (INTEGER, LONG, DOUBLE),
         DATE: (DATE,), TIMESTAMP: (DATE, TIMESTAMP), STRING: KINDS}
EXAMPLES = 5
MAX_VARIANTS = 1000

_WHOLE = r"^[+-]?[0-9]{1,19}$"
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"
_DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
_TIME = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}([.][0-9]{1,6})?)?$"


def kind_of(value: Column) -> Column:
    """The narrowest kind of a text value; NULL for NULL. Plain comparisons come
    first, so a value meets the patterns that it can match only."""
    number_like = (value >= "+") & (value < ":")  # begins with a sign, a point or a digit
    dashed = F.substring(value, 5, 1) == "-"
    return (F.when(value.isNull(), F.lit(None).cast("string"))
            .when(~number_like, F.when(F.lower(value).isin("true", "false"), F.lit(BOOLEAN)).otherwise(F.lit(STRING)))
            .when(dashed & value.rlike(_DATE) & value.try_cast("date").isNotNull(), F.lit(DATE))
            .when(dashed & value.rlike(_TIME) & value.try_cast("timestamp_ntz").isNotNull(), F.lit(TIMESTAMP))
            .when(value.rlike(_WHOLE), F.when(value.try_cast("int").isNotNull(), F.lit(INTEGER))
                  .when(value.try_cast("bigint").isNotNull(), F.lit(LONG)).otherwise(F.lit(DOUBLE)))
            .when(value.rlike(_NUMBER), F.lit(DOUBLE))
            .otherwise(F.lit(STRING)))


def narrowest(counts: dict[str, int], tolerance: float = 0.0) -> str:
    """The least kind that holds all but a ``tolerance`` share of the values; of
    several, the one with the fewest rejects. No values: string."""
    total = sum(counts.values())
    if not total:
        return STRING
    if not tolerance:
        return next(k for k in KINDS if all(c in HOLDS[k] for c, n in counts.items() if n))
    fits = [(rejects(counts, k), KINDS.index(k), k) for k in KINDS]
    fits = [f for f in fits if f[0] <= tolerance * total]
    # string always fits; a proper type is preferred to it
    return min([f for f in fits if f[2] != STRING] or fits)[2]


def rejects(counts: dict[str, int], kind: str) -> int:
    return sum(n for c, n in counts.items() if c not in HOLDS[kind])


@dataclass(frozen=True)
class Variant:
    """Files that share one header."""

    header: tuple[str, ...]
    paths: tuple[str, ...]


@dataclass(frozen=True)
class InferredColumn:
    name: str
    kind: str
    counts: dict[str, int]
    nulls: int
    rejected: int
    examples: tuple[str, ...]
    variants: int


@dataclass(frozen=True)
class Inferred:
    """What ``infer`` found: columns in order of first appearance."""

    columns: tuple[InferredColumn, ...]
    variants: tuple[Variant, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, SPARK_TYPES[c.kind]) for c in self.columns])


def variants(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> list[Variant]:
    """The distinct headers and their files. A header is the first line of the
    split at a file's start; ``min_by`` over the reading order is a map-side
    aggregate. The driver gets one row a file, as its file listing does."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    first = (lines.withColumn("at", F.monotonically_increasing_id()).filter("start = 0")
             .groupBy("file").agg(F.min_by("value", "at").alias("line")))
    by_line: dict[str, list[str]] = {}
    for r in first.collect():
        by_line.setdefault(r["line"], []).append(r["file"])
    if len(by_line) > MAX_VARIANTS:
        raise ValueError(f"{len(by_line)} different headers: are these files with a header line?")
    if not by_line:
        return []
    # the header lines themselves, split by Spark's CSV parser
    named = spark.createDataFrame([(line,) for line in sorted(by_line)], "line string")
    width = max(line.count(sep) for line in by_line) + 1
    fields = F.from_csv("line", ", ".join(f"c{i} string" for i in range(width)), {"sep": sep})
    out = []
    for r in named.select("line", F.array_compact(F.array(*[fields[f"c{i}"] for i in range(width)])).alias("h")).collect():
        if len(set(r["h"])) < len(r["h"]):
            raise ValueError(f"a header names a column twice: {r['line']}")
        out.append(Variant(tuple(r["h"]), tuple(sorted(by_line[r["line"]]))))
    return sorted(out, key=lambda v: (-len(v.paths), v.paths))


def _text(spark: SparkSession, v: Variant, sep: str) -> DataFrame:
    """One variant with all fields as text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in v.header])
    return spark.read.schema(schema).option("header", True).option("sep", sep).option("enforceSchema", False).csv(list(v.paths))


def _all_text(spark: SparkSession, found: Sequence[Variant], sep: str) -> DataFrame:
    out = None
    for v in found:
        part = _text(spark, v, sep)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


@dataclass(frozen=True)
class Survey:
    """One pass over all values: their kinds, counted by column. Any number of
    ``infer`` calls, of any tolerance, start from it."""

    variants: tuple[Variant, ...]
    counts: dict[str, dict[str, int]]
    nulls: dict[str, int]


def survey(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> Survey:
    """Count the kinds of all values below ``path``. Each value is one row of a
    (column, kind) count with map-side partials, so its kind is found once; the
    driver gets at most a row for each column and kind."""
    found = variants(spark, path, sep)
    if not found:
        return Survey((), {}, {})
    text = _all_text(spark, found, sep)
    names = text.columns
    values = text.select(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)]).unpivot(
        [], [f"c{i}" for i in range(len(names))], "at", "v")
    kinds = values.groupBy("at", kind_of(F.col("v")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    got = {(r["at"], r["kind"]): r["n"] for r in kinds.collect()}
    return Survey(tuple(found), {n: {k: got.get((f"c{i}", k), 0) for k in KINDS} for i, n in enumerate(names)},
                  {n: got.get((f"c{i}", None), 0) for i, n in enumerate(names)})


def infer(spark: SparkSession, path: str | Sequence[str] | Survey, tolerance: float = 0.0, sep: str = ",",
          examples: int = EXAMPLES) -> Inferred:
    """Columns and types of all files below ``path`` (or of those of a ``survey``)."""
    seen = path if isinstance(path, Survey) else survey(spark, path, sep)
    if not seen.variants:
        return Inferred((), ())
    kinds = {n: narrowest(c, tolerance) for n, c in seen.counts.items()}
    bad = {n: k for n, k in kinds.items() if rejects(seen.counts[n], k)}
    shown = _examples(_all_text(spark, seen.variants, sep), bad, examples) if bad else {}
    return Inferred(tuple(
        InferredColumn(n, k, seen.counts[n], seen.nulls[n], rejects(seen.counts[n], k), shown.get(n, ()),
                       sum(n in v.header for v in seen.variants))
        for n, k in kinds.items()), seen.variants)


def _examples(text: DataFrame, kinds: dict[str, str], limit: int) -> dict[str, tuple[str, ...]]:
    """The smallest rejected values of each column: a bounded top-k each."""
    out = {}
    for name, kind in kinds.items():
        value = F.col(f"`{name}`")
        bad = text.select(value.alias("v")).filter(~kind_of(F.col("v")).isin(*HOLDS[kind]))
        out[name] = tuple(r["v"] for r in bad.distinct().orderBy("v").limit(limit).collect())
    return out


def read_inferred(spark: SparkSession, inferred: Inferred, sep: str = ",", corrupt: bool = False) -> DataFrame:
    """The files' rows in the inferred types; a rejected value is NULL, and
    ``corrupt`` adds the whole record of such a row (as ``raw.read_csv`` does)."""
    schema, out = inferred.schema, None
    for v in inferred.variants:
        fields = [schema[c] for c in v.header]
        reader = spark.read.option("header", True).option("sep", sep).option("enforceSchema", False)
        if corrupt:
            fields = [*fields, T.StructField(CORRUPT_COL, T.StringType())]
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
        part = reader.schema(T.StructType(fields)).csv(list(v.paths))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], schema)
    return out.select(*[f"`{c}`" for c in schema.names], *([CORRUPT_COL] if corrupt else []))


REPORT = ("position int, column_name string, kind string, values long, nulls long, rejected long, examples array<string>, "
          "variants int, " + ", ".join(f"n_{k} long" for k in KINDS))


def report(spark: SparkSession, inferred: Inferred) -> DataFrame:
    """One row a column."""
    return spark.createDataFrame(
        [(i, c.name, c.kind, sum(c.counts.values()), c.nulls, c.rejected, list(c.examples), c.variants,
          *[c.counts[k] for k in KINDS]) for i, c in enumerate(inferred.columns)], REPORT)


def _kind_of_type(t: T.DataType) -> str:
    if isinstance(t, T.TimestampType):
        return TIMESTAMP
    return next((k for k, s in SPARK_TYPES.items() if type(s) is type(t)), STRING)


SAME, ADDED, MISSING, MOVED, NARROWER, WIDER, CHANGED = (
    "same", "added", "missing", "moved", "narrower", "wider", "changed")


def drift(spark: SparkSession, inferred: Inferred, declared: T.StructType) -> DataFrame:
    """(column_name, status, declared, inferred, rejected): what differs from a
    declared schema. ``rejected``: values that the declared type can not hold.

    added: only in the files; missing: in no file; narrower: the declared type
    holds all values (no loss); wider: the inferred type holds the declared one;
    changed: neither does; moved: same type, another place in some file.
    """
    rows, found = [], {c.name: c for c in inferred.columns}
    for i, f in enumerate(declared.fields):
        c = found.get(f.name)
        said = _kind_of_type(f.dataType)
        if c is None:
            rows.append((f.name, MISSING, said, None, 0))
            continue
        if c.kind == said or not sum(c.counts.values()):
            at = [v.header.index(f.name) for v in inferred.variants if f.name in v.header]
            status = SAME if all(p == i for p in at) else MOVED
        elif c.kind in HOLDS[said]:
            status = NARROWER
        else:
            status = WIDER if said in HOLDS[c.kind] else CHANGED
        rows.append((f.name, status, said, c.kind, rejects(c.counts, said)))
    rows += [(c.name, ADDED, None, c.kind, 0) for c in inferred.columns if c.name not in declared.names]
    return spark.createDataFrame(rows, "column_name string, status string, declared string, inferred string, rejected long")
