"""Grouping, distinct, pivot and batch deduplication (all partial-aggregating)."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def group_count(df: DataFrame, keys: Sequence[str | Column], col: str, name: str = "n") -> DataFrame:
    """``count(col)`` (non-NULL) per group."""
    return df.groupBy(*keys).agg(F.count(col).alias(name))


def group_sum(df: DataFrame, keys: Sequence[str | Column], col: str | Column, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(col).alias(name))


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def pivot_sum(df: DataFrame, group_cols: Sequence[str], pivot_col: str, values: Sequence,
              measure: str | Column, alias: Mapping | None = None) -> DataFrame:
    """PIVOT with a fixed value list; a value absent from a group gives NULL.

    With the list given, Spark needs no extra job to find the distinct values,
    and the aggregation is one partial+final ``sum(if(p = v, x, NULL))`` per value.
    """
    out = df.groupBy(*group_cols).pivot(pivot_col, list(values)).agg(F.sum(measure))
    if alias:
        for v, name in alias.items():
            out = out.withColumnRenamed(str(v), name)
    return out


def dedup_batch(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key (which one is unspecified, as in SQL)."""
    return df.dropDuplicates(list(keys))


def collect_sorted_set(col: str | Column) -> Column:
    """``collect_set`` with a defined order, for comparison and display."""
    return F.array_sort(F.collect_set(col))


def flatten_distinct(col: str | Column) -> Column:
    """``array_distinct(flatten(collect_set(arr)))`` sorted, as one aggregate expression.

    It gathers every distinct array of a group in one task before flattening;
    ``distinct_elements`` computes the same set without that.
    """
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(col))))


def distinct_elements(df: DataFrame, keys: Sequence[str], array_col: str | Column,
                      name: str) -> DataFrame:
    """Per group, the sorted distinct elements of an array column (``flatten_distinct``).

    Planned as explode → ``distinct`` on (keys, element) → collect: the distinct
    step is a partial aggregate hashed on the element too, so a group holding a
    large share of all rows is deduplicated across many tasks, and the final
    collect receives at most one row per distinct element.  A group whose arrays
    are all NULL or empty gets an empty array.
    """
    arr = F.col(array_col) if isinstance(array_col, str) else array_col
    pairs = df.select(*keys, F.explode_outer(arr).alias("_e")).distinct()
    return pairs.groupBy(*keys).agg(F.array_sort(F.collect_list("_e")).alias(name))
