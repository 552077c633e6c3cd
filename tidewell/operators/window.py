"""Latest row per key.

* ``method="max_by"`` (default): one row per key.  With a single order column the largest
  value per key is a hash aggregate (each map task combines its rows before the shuffle),
  semi-joined back; ties are then broken by the remaining columns among the survivors.
  With several order columns the whole row is aggregated by ``max_by``.
* ``method="rank"``: the rows ``rank() = 1`` would keep (ties all kept, as
  the reference does, so downstream MERGE may see duplicates): the same without the
  tie-break.

A hot key costs one row per map task in the aggregate, and adaptive skew handling splits
it in the join; it is never sorted in one window task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | str,
                   method: str = "max_by") -> DataFrame:
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    if method not in ("rank", "max_by"):
        raise ValueError(f"unknown method {method!r}")
    if method == "rank" or len(order) == 1:
        # plain maximum for one column: a struct buffer would force a sort aggregate
        top = F.max(order[0]) if len(order) == 1 else F.max(F.struct(*[F.col(c) for c in order]))
        tops = df.groupBy(*[F.col(k).alias(f"_top_k{i}") for i, k in enumerate(keys)]).agg(top.alias("_top"))
        mine = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
        cond = [F.col(k).eqNullSafe(F.col(f"_top_k{i}")) for i, k in enumerate(keys)] + [mine.eqNullSafe(F.col("_top"))]
        df = df.join(tops, cond, "left_semi")
    if method == "rank":
        return df
    rest = [c for c in df.columns if c not in keys]
    # order columns first so the struct comparison is by time, then by row content
    ordering = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    row = F.struct(*[F.col(c) for c in rest])
    return (df.groupBy(*keys).agg(F.max_by(row, ordering).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
            .select(*df.columns))
