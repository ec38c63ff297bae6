"""Bronze ingest: raw rows plus audit columns, written once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.calendar import now_ts
from . import raw

BRONZE_LAYER = "bronze"


def add_audit(df: DataFrame, now=None) -> DataFrame:
    """``ingestion_timestamp``, ``source_file`` (hidden file-metadata column) and
    the layer tag. Must be applied directly on a file scan (``_metadata`` is a
    property of the scan)."""
    return df.withColumns({
        "ingestion_timestamp": now_ts(now),
        "source_file": F.col("_metadata.file_path"),
        "bronze_layer": F.lit(BRONZE_LAYER),
    })


def ingest_csv(spark: SparkSession, path: str, schema: StructType | str, now=None) -> DataFrame:
    """CSV scan (explicit schema, records that fail to parse kept) + audit
    columns, lazy."""
    return add_audit(raw.read_csv(spark, path, schema, corrupt=True), now)


def ingest_all(spark: SparkSession, paths: Mapping[str, str], now=None,
               schemas: Mapping[str, StructType] | None = None) -> dict[str, DataFrame]:
    """All four raw inputs (``orders``, ``customers``, ``restaurants``, ``partners``)."""
    return {name: ingest_csv(spark, p, (schemas or {}).get(name, name), now)
            for name, p in paths.items()}
