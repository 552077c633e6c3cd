"""Positions and running sums in a global order, without one task that sees a whole group."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidewell.session import scratch_path

ROWS_PER_TASK = 50_000


def positions(rows: DataFrame, group: Sequence[str], order: Sequence[str], value: str | None = None) -> DataFrame:
    """``rows`` with ``position`` (from 0) in their group and, with ``value``, ``before``: the sum of that
    column over the earlier rows of the group.

    Rows are partitioned by range of (group, order, running number), so that a group, or one
    key given many times, spreads over as many tasks as its rows need; rows that are equal in
    all of these columns are interchangeable.  The sorted rows are written to the shared
    scratch folder; a task's row numbers and one row for each (group, task) give the rest.
    Group columns must not be null.  ``rows`` is evaluated twice (range sample and sort): pass
    a stored table.
    """
    spark = rows.sparkSession
    tasks = max(1, -(-rows.count() // ROWS_PER_TASK))
    by = [*group, *order, "_nth"]
    path = scratch_path(spark, "positions")
    (rows.withColumn("_nth", F.monotonically_increasing_id()).repartitionByRange(tasks, *by).sortWithinPartitions(*by)
     .drop("_nth").withColumn("_rid", F.monotonically_increasing_id()).write.parquet(path))
    stored = spark.read.parquet(path).withColumn("_task", F.shiftrightunsigned("_rid", 33))
    key = [*group, "_task"]
    added = [] if value is None else [F.sum(value).alias("_v")]
    share = stored.groupBy(*key).agg(F.min("_rid").alias("_at"), F.count(F.lit(1)).alias("_n"), *added)
    earlier = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in (["_n"] if value is None else ["_n", "_v"])]
    share = share.select(*key, "_at", *sums)
    out = stored.join(share, key).withColumn("position", F.col("_n") + F.col("_rid") - F.col("_at"))
    if value is not None:
        local = Window.partitionBy(*key).orderBy("_rid").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("before", F.col("_v") + F.coalesce(F.sum(value).over(local), F.lit(0)))
    return out.drop("_rid", "_task", "_at", "_n", "_v")
