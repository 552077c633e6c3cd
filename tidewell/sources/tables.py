"""Reading the driver tables (one Parquet file per table) and inline rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Batch scan of a driver table; column pruning and filters reach the Parquet reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table, batch (``spark.read.table``)."""
    return spark.read.table(name)


def inline_rows(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Small literal tables (``INSERT … VALUES``); only for unit-sized inputs."""
    return spark.createDataFrame(rows, schema)
