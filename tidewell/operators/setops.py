"""Set operations: UNION [ALL], INTERSECT [ALL], EXCEPT [ALL] by column name."""

from __future__ import annotations

from pyspark.sql import DataFrame


def set_union(a: DataFrame, b: DataFrame, distinct: bool = True) -> DataFrame:
    u = a.unionByName(b)
    return u.distinct() if distinct else u


def set_intersect(a: DataFrame, b: DataFrame, all: bool = False) -> DataFrame:
    b = b.select(*a.columns)
    return a.intersectAll(b) if all else a.intersect(b)


def set_except(a: DataFrame, b: DataFrame, all: bool = False) -> DataFrame:
    b = b.select(*a.columns)
    return a.exceptAll(b) if all else a.subtract(b)
