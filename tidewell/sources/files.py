"""File scans: JSON, CSV, text, binary and Parquet, with row provenance.

All readers take an explicit schema where one is known; inference costs an
extra pass over the files and is kept for the ``*_inferred`` entry points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines from one file, a glob or a directory (all files one relation)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def scan_text(spark: SparkSession, path: str) -> DataFrame:
    """Each line as one ``value`` string (for looking at malformed files)."""
    return spark.read.text(path)


def scan_binary(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Whole files: ``path, modificationTime, length, content``."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def scan_csv(spark: SparkSession, path: str, schema: StructType | str, sep: str = ";",
             header: bool = True) -> DataFrame:
    """Delimited files with a header and a declared schema."""
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .csv(path))


def scan_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """CSV with default options: comma separator, no header, ``_cN`` string columns."""
    return spark.read.csv(path)


def scan_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def source_file() -> Column:
    """Row provenance: the file a row was read from (hidden ``_metadata`` column)."""
    return F.col("_metadata.file_path")


def with_provenance(df: DataFrame, name: str = "source_file") -> DataFrame:
    return df.withColumn(name, source_file())
