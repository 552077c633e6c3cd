"""Type-2 slowly changing dimension: closed and current versions per key.

``scd2_apply(target, updates, …)`` applies a batch of updates to a type-2
table.  Rows of one key are taken in time order; an update opens a new version only
when the tracked value differs from the value in force (``<>``, so NULL never
differs), which closes the previous version at the update's time.  A key never seen
before is inserted from its first update.  With an empty target the same function
builds the whole history from a feed (``scd2_history``).

Several rows of a key with one time count as one: the largest by (tracked value,
attributes) wins, whether it is an update or a version of the table.  An update at or
before the start of its key's current version is late: all versions of that key are
sequenced anew with it, so versions of a key never overlap and none has length zero.
(What an earlier batch did not store, because it changed nothing then, stays
unknown: a late update between two equal values ends with itself in force.)

Only the batch and, of keys it mentions, the current rows (all rows where it is late)
take part in the sequencing; everything else passes through untouched, so a
batch costs in proportion to its own keys, not to the table.

Plan: a key's rows are cut into chunks by time (``chunk_width``), and all windows run
per (key, chunk), so a key holding a large share of all rows is spread over many
tasks.  What a chunk needs from earlier or later chunks of the same key (last
value in force, whether any row came before, the next version's start) comes from
a per-chunk summary with one row per (key, chunk).  Nothing is sampled or run while
the plan is built.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F, types as T

CURRENT, EFFECTIVE, END = "current", "effective_date", "end_date"
CH = "_chunk"
CHUNK_SECONDS = 30 * 86_400


def _chunk(time_type: T.DataType, width: int | None) -> Column:
    """Number of the time chunk of a row: ``width`` seconds of a time, or units of a number."""
    if isinstance(time_type, T.NumericType):
        return F.floor(F.col(EFFECTIVE) / (width or 1 << 16)).cast("long")
    return F.floor(F.unix_seconds(F.col(EFFECTIVE).cast("timestamp")) / (width or CHUNK_SECONDS)).cast("long")


def _sequence(target: DataFrame | None, updates: DataFrame, key: str, tracked: str, ts: str,
              attrs: Sequence[str]):
    """(rows that stay as they are, rows to sequence: one per key and time, columns)."""
    cols = [key, *attrs, tracked]
    out_cols = [*cols, CURRENT, EFFECTIVE, END]
    seq, passthrough = updates.select(*cols, F.col(ts).alias(EFFECTIVE)), None
    if target is not None:
        # keys of the batch with their first time, and the start of their current version: one row
        # a key, matched NULL-safe like the windows' grouping.  One left join tags every target row.
        first = updates.groupBy(F.col(key).alias("_bk")).agg(F.min(ts).alias("_first"))
        now = target.filter(F.col(CURRENT)).select(F.col(key).alias("_ck"), F.col(EFFECTIVE).alias("_since"))
        first = first.join(now, F.col("_bk").eqNullSafe(F.col("_ck")), "left").select(
            "_bk", F.coalesce(F.col("_first") <= F.col("_since"), F.lit(False)).alias("_late"))
        tagged = target.join(first, F.col(key).eqNullSafe(F.col("_bk")), "left").withColumn(
            "_seq", F.coalesce(F.col("_late") | F.col(CURRENT), F.lit(False)) & F.col("_late").isNotNull())
        passthrough = tagged.filter(~F.col("_seq")).select(*out_cols)
        seq = tagged.filter(F.col("_seq")).select(*cols, EFFECTIVE).unionByName(seq)
    rest = [tracked, *attrs]
    seq = seq.groupBy(key, EFFECTIVE).agg(F.max(F.struct(*rest)).alias("_r")).select(
        key, *[F.col(f"_r.{c}").alias(c) for c in rest], EFFECTIVE)
    return passthrough, seq, cols


def scd2_apply(target: DataFrame | None, updates: DataFrame, key: str, tracked: str, ts: str,
               attrs: Sequence[str] = (), chunk_width: int | None = None) -> DataFrame:
    closed, seq, cols = _sequence(target, updates, key, tracked, ts, attrs)
    seq = seq.withColumn(CH, _chunk(seq.schema[EFFECTIVE].dataType, chunk_width))
    local = Window.partitionBy(key, CH).orderBy(EFFECTIVE)
    before = local.rowsBetween(Window.unboundedPreceding, -1)
    stamp = F.struct(F.col(EFFECTIVE))

    # ---- pass 1: which rows start a version --------------------------------------------
    nonnull = F.when(F.col(tracked).isNotNull(), F.struct(stamp.alias("o"), F.col(tracked).alias("v")))
    per_chunk = (seq.groupBy(key, CH)
                 .agg(F.max(nonnull).alias("_last"), F.count(F.lit(1)).alias("_n"),
                      F.min(F.struct(stamp.alias("o"), F.col(tracked).isNull().alias("z"))).alias("_first")))
    by_chunk = Window.partitionBy(key).orderBy(CH)
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    # a key whose first version holds NULL keeps it: NULL <> x is never true
    carried = per_chunk.select(
        key, CH,
        F.last(F.col("_last.v"), ignorenulls=True).over(earlier).alias("_carry_v"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_carry_n"),
        F.first(F.col("_first.z")).over(by_chunk.rowsBetween(Window.unboundedPreceding, 0))
        .alias("_null_first"))
    marked = (seq.withColumn("_prev_local", F.last(F.col(tracked), ignorenulls=True).over(before))
              .withColumn("_n_local", F.count(F.lit(1)).over(before))
              .join(carried, [key, CH], "left"))
    prev = F.coalesce(F.col("_prev_local"), F.col("_carry_v"))
    n_before = F.col("_n_local") + F.coalesce(F.col("_carry_n"), F.lit(0))
    starts = marked.filter((n_before == 0)
                           | (~F.col("_null_first") & F.coalesce(F.col(tracked) != prev, F.lit(False))))
    starts = starts.select(*cols, EFFECTIVE, CH)

    # ---- pass 2: each version ends where the key's next version starts -------------------
    first_start = starts.groupBy(key, CH).agg(F.min(stamp).alias("_first"))
    later = Window.partitionBy(key).orderBy(CH).rowsBetween(1, Window.unboundedFollowing)
    nxt_chunk = first_start.select(key, CH, F.first(F.col("_first." + EFFECTIVE), ignorenulls=True)
                                   .over(later).alias("_next_chunk"))
    versions = (starts.withColumn("_next_local", F.lead(EFFECTIVE).over(local))
                .join(nxt_chunk, [key, CH], "left")
                .withColumn(END, F.coalesce(F.col("_next_local"), F.col("_next_chunk")))
                .select(*cols, F.col(END).isNull().alias(CURRENT), EFFECTIVE, END))
    return versions if closed is None else closed.unionByName(versions)


def scd2_history(feed: DataFrame, key: str, tracked: str, ts: str, attrs: Sequence[str] = (),
                 chunk_width: int | None = None) -> DataFrame:
    return scd2_apply(None, feed, key, tracked, ts, attrs, chunk_width)


def scd2_current(table: DataFrame, key: str, tracked: str, attrs: Sequence[str] = ()) -> DataFrame:
    """``SELECT key, attrs, tracked FROM t WHERE current IS TRUE``."""
    return table.filter(F.col(CURRENT) == True).select(key, *attrs, tracked)  # noqa: E712
