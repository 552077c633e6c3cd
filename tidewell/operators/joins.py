"""Joins."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame


def broadcast_lookup(fact: DataFrame, dim: DataFrame, on: Column | str | Sequence[str],
                     how: str = "inner") -> DataFrame:
    """Join a fact to a lookup without a forced hint.

    Spark broadcasts the lookup when its size in bytes is below
    ``spark.sql.autoBroadcastJoinThreshold``, by its statistics or, with adaptive
    execution, by what it measured; a larger one is shuffled.
    """
    return fact.join(dim, on, how)


def semi_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """``WHERE k IN (subquery)``."""
    return left.join(right, on, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """``WHERE NOT EXISTS`` / ``WHEN NOT MATCHED``."""
    return left.join(right, on, "left_anti")
