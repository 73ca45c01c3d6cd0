"""Scans of the driver's parquet tables.

Scans are lazy; callers select the columns they need so Catalyst prunes
the parquet ``ReadSchema`` and pushes filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in BASE_TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def read_typed(spark: SparkSession, path: str, schema) -> DataFrame:
    """Typed scan of a stored table.  The schema is pinned, not
    inferred, so a drifted file fails at read time instead of mid-job."""
    return spark.read.schema(schema).parquet(path)
