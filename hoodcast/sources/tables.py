"""Parquet scans of the driver's tables (A1). Column pruning and filter
pushdown are left to Catalyst: callers select what they use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table. How many tasks scan it is the session's business
    (``spark.sql.files.maxPartitionBytes`` and the file's row groups)."""
    return spark.read.parquet(table_path(sf_dir, name))
