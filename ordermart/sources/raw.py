"""Raw-input scans: CSV with an explicit schema, path scans, catalog tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import CORRUPT_COL, EMPTY_PARTITION, RAW_SCHEMAS

Reader = TypeVar("Reader", DataFrameReader, DataStreamReader)


def csv_reader(reader: Reader, schema: StructType | str, mode: str = "PERMISSIVE",
               corrupt: bool = False) -> Reader:
    """Options of every CSV scan, batch or stream: a header that must name the
    schema's columns in order (a reordered file fails instead of shifting
    values) and an explicit schema.

    ``corrupt`` adds a column with the whole record where a value could not be
    parsed; without it such a value is just NULL.
    """
    if isinstance(schema, str):
        schema = RAW_SCHEMAS[schema]
    reader = reader.option("header", True).option("mode", mode).option("enforceSchema", False)
    if corrupt:
        schema = StructType([*schema.fields, StructField(CORRUPT_COL, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    return reader.schema(schema)


def read_csv(spark: SparkSession, path: str, schema: StructType | str,
             mode: str = "PERMISSIVE", corrupt: bool = False, **options: str) -> DataFrame:
    """CSV with header and an explicit schema.

    ``schema`` is a StructType or the name of a raw table (``orders``,
    ``customers``, ``restaurants``, ``partners``). An explicit schema avoids
    the extra full pass of ``inferSchema`` and keeps types stable across
    files; malformed fields become NULL in PERMISSIVE mode, and ``corrupt``
    keeps their records.
    """
    reader = csv_reader(spark.read, schema, mode, corrupt)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet",
              text_partitions: Sequence[str] = ()) -> DataFrame:
    """Columnar path scan; ``fmt="delta"`` works where that package is installed.

    ``text_partitions``: folder columns that are text, whatever their values
    look like ('007' stays '007'); empty strings written by
    ``write_partitioned`` come back as empty strings.
    """
    df = spark.read.format(fmt).load(path)
    if not text_partitions:
        return df
    schema = StructType([StructField(f.name, StringType()) if f.name in text_partitions else f
                         for f in df.schema.fields])
    df = spark.read.schema(schema).format(fmt).load(path)
    return df.withColumns({c: F.when(F.col(c) == EMPTY_PARTITION, F.lit("")).otherwise(F.col(c))
                           for c in text_partitions})


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
