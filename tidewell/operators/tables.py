"""Table writes: CTAS, replace, overwrite, append, CSV sink, additive schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.session import scratch_path


def ctas(df: DataFrame, name: str, path: str | None = None, partition_by=None) -> DataFrame:
    """``CREATE TABLE name AS SELECT …`` (schema from the query); returns the table."""
    w = df.write.format("parquet").option("path", path or scratch_path(df.sparkSession, f"table-{name}"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """``CREATE OR REPLACE TABLE … AS``: rows and schema both replaced."""
    spark = df.sparkSession
    path = scratch_path(spark, f"table-{name}")  # new files; the old version stays readable by path
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)


def overwrite_rows(df: DataFrame, name: str) -> DataFrame:
    """``INSERT OVERWRITE``: the table must exist and the columns must match.

    Spark refuses to overwrite a table the query reads from: write a query over the
    target itself to a scratch copy first.
    """
    spark = df.sparkSession
    target_cols = spark.table(name).columns
    if len(df.columns) != len(target_cols):
        raise ValueError(f"INSERT OVERWRITE: {len(df.columns)} columns for {len(target_cols)}-column table")
    df.write.insertInto(name, overwrite=True)
    return spark.table(name)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Materialise ``df`` under the checkpoint root and read it back (cuts lineage)."""
    path = scratch_path(df.sparkSession, f"stage-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def append_rows(df: DataFrame, name: str) -> DataFrame:
    """``INSERT INTO``: rows added, no deduplication."""
    df.write.insertInto(name)
    return df.sparkSession.table(name)


def sink_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True) -> None:
    df.write.mode("append").option("header", header).option("sep", sep).csv(path)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append with new columns allowed; readers use ``mergeSchema`` to see old and new files."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def create_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW``: the query's text goes into the catalog; returns the view."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)
