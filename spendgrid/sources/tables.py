"""Reading the input tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


_SCANS: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Scan ``<base_dir>/<name>.parquet`` (column pruning and filter pushdown
    reach the parquet reader through the lazy plan).

    The scan is created once per application and path: creating it reads
    the file footer for the schema (a small job), and the adapter uses the
    same table in several places of one plan. Reusing the scan is safe for
    read-only inputs; the data itself is read when a plan runs."""
    path = os.path.join(base_dir, f"{name}.parquet")
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(path)
    return _SCANS[key]


def table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table by name (``spark.table``)."""
    return spark.table(name)
