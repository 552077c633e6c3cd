"""Change feeds, as-of reads, restores and snapshot differences.

A change feed is an ordinary DataFrame: the table's columns plus
``_change_type`` (insert, update_preimage, update_postimage, delete),
``_commit_version`` and ``_commit_timestamp``.  Everything here is joins,
aggregates and per-key windows over it; nothing is collected.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CT, CV, CTS = "_change_type", "_commit_version", "_commit_timestamp"
CHANGE_TYPES = ["insert", "update_preimage", "update_postimage", "delete"]


def cdc_change_feed(feed: DataFrame, keys: Sequence[str], seq: str, status: str,
                    version: Column, delete_value: str = "delete",
                    drop: Sequence[str] = ()) -> DataFrame:
    """Change feed of a table kept by applying ``feed`` one commit per ``version``.

    Within a commit each key's last row (by ``seq``) wins; a row whose
    ``status`` is ``delete_value`` removes the key.  Per key, the state after
    each commit is compared with the state after the key's previous commit.
    ``_commit_timestamp`` is the commit's largest ``seq`` (not the clock), so
    re-running yields identical rows.
    """
    keys = list(keys)
    data_cols = [c for c in feed.columns if c not in keys and c not in drop]
    v = feed.withColumn(CV, version)
    # one row per commit; a plain join, so adaptive execution broadcasts it after
    # measuring its real size and shuffles it otherwise
    commit_ts = v.groupBy(CV).agg(F.max(seq).alias(CTS))
    rest = [c for c in data_cols if c != seq]
    last = (v.groupBy(*keys, CV)
            .agg(F.max_by(F.struct(*[F.col(c) for c in data_cols]),
                          F.struct(F.col(seq), *[F.col(c) for c in rest])).alias("_now")))
    w = Window.partitionBy(*keys).orderBy(CV)
    live = lambda r: r.isNotNull() & (r[status] != F.lit(delete_value))
    per = last.withColumn("_prev", F.lag("_now").over(w))
    now_live, prev_live = live(F.col("_now")), live(F.col("_prev"))
    row = lambda r, kind: F.struct(*[F.col(k) for k in keys],
                                   *[F.col(f"{r}.{c}").alias(c) for c in data_cols],
                                   F.lit(kind).alias(CT))
    events = F.when(now_live & ~prev_live, F.array(row("_now", "insert"))) \
        .when(now_live & prev_live, F.array(row("_prev", "update_preimage"), row("_now", "update_postimage"))) \
        .when(~now_live & prev_live, F.array(row("_prev", "delete")))
    changes = per.select(CV, F.explode(events).alias("r")).select("r.*", CV)
    return changes.join(commit_ts, CV).select(*keys, *data_cols, CT, CV, CTS)


def changes_between(feed: DataFrame, start: int, end: int | None = None) -> DataFrame:
    """``table_changes(t, start[, end])``: a filter on the version, which prunes partitions when
    the feed is stored by version (``store_feed``)."""
    c = F.col(CV) >= start
    if end is not None:
        c = c & (F.col(CV) <= end)
    return feed.filter(c)


def as_of_version(feed: DataFrame, keys: Sequence[str], version: int | None = None) -> DataFrame:
    """State as of ``version`` (``VERSION AS OF n``): replay of the feed.

    Per key, the last non-preimage change with ``_commit_version <= n``; keys
    whose last change is a delete are absent.  One partial aggregate.
    """
    keys = list(keys)
    f = feed.filter(F.col(CT) != "update_preimage")
    if version is not None:
        f = f.filter(F.col(CV) <= version)
    data_cols = [c for c in feed.columns if c not in keys and c not in (CT, CV, CTS)]
    last = f.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in data_cols], F.col(CT)),
                                         F.col(CV)).alias("_r"))
    return (last.filter(F.col(f"_r.{CT}") != "delete")
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in data_cols]))


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows turning ``before`` into ``after`` (rows compared whole, NULL-safe)."""
    keys = list(keys)
    cols = [c for c in after.columns]
    data = [c for c in cols if c not in keys]
    b = before.select(*[F.col(k).alias(f"_kb{i}") for i, k in enumerate(keys)],
                      F.struct(*data).alias("_b"), F.xxhash64(*data).alias("_hb"))
    a = after.select(*[F.col(k).alias(f"_ka{i}") for i, k in enumerate(keys)],
                     F.struct(*data).alias("_a"), F.xxhash64(*data).alias("_ha"))
    same = [F.col(f"_kb{i}").eqNullSafe(F.col(f"_ka{i}")) for i in range(len(keys))]
    j = b.join(a, same, "full_outer").select(
        *[F.when(F.col("_b").isNull(), F.col(f"_ka{i}")).otherwise(F.col(f"_kb{i}")).alias(k)
          for i, k in enumerate(keys)], "_b", "_hb", "_a", "_ha")
    row = lambda s, kind: F.struct(*[F.col(k) for k in keys],
                                   *[F.col(f"{s}.{c}").alias(c) for c in data], F.lit(kind).alias(CT))
    ev = (F.when(F.col("_b").isNull(), F.array(row("_a", "insert")))
          .when(F.col("_a").isNull(), F.array(row("_b", "delete")))
          .when((F.col("_ha") != F.col("_hb")) | ~F.col("_a").eqNullSafe(F.col("_b")),
                F.array(row("_b", "update_preimage"), row("_a", "update_postimage"))))
    return j.select(F.explode(ev).alias("r")).select("r.*")


def bucket_digests(df: DataFrame, bucket: Column) -> DataFrame:
    """``(bucket, digest)``: a digest of each bucket's rows that does not depend on their order.

    Per bucket the row count, the exclusive or of one 64-bit hash of the rows and the two halves of the sum of another,
    so equal rows given twice do not cancel out; nulls are hashed by their place.  One partial aggregate: a task
    sends one row per bucket.  The halves fit a long for up to 2^31 rows in a bucket.
    """
    values = [F.col(_quote(c)) for c in df.columns]
    nulls = [v.isNull() for v in values]
    h, g = F.xxhash64(*values, *nulls), F.xxhash64(F.lit(1), *nulls, *values)
    return (df.select(bucket.alias("bucket"), h.alias("h"), g.alias("g")).groupBy("bucket")
            .agg(F.struct(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"),
                          F.sum(F.shiftright("g", 32)).alias("hi"),
                          F.sum(F.col("g").bitwiseAND(F.lit(0xFFFFFFFF))).alias("lo")).alias("digest")))


def snapshot_diff_by_digest(before: DataFrame, after: DataFrame, keys: Sequence[str], buckets: int = 4096,
                            bucket_by: str | None = None) -> DataFrame:
    """``snapshot_diff`` that joins only the buckets whose digests differ.

    Buckets are hashes of the keys, ``buckets`` of them, or ``bucket_by``: SQL over key columns.  Where changes are
    local (new orders, the last days), an expression that follows them leaves most buckets equal, and their rows
    are read and hashed but not shuffled; with changes all over the table nothing is saved.  The result is
    that of ``snapshot_diff``.  A bucket that only one side has differs.  Two different buckets pass for equal
    only if both 64-bit digests and the counts agree.
    """
    keys = list(keys)
    bucket = (F.coalesce(F.expr(bucket_by).cast("long"), F.lit(-1).cast("long")) if bucket_by
              else F.pmod(F.xxhash64(*[F.col(_quote(k)) for k in keys]), F.lit(buckets)))
    changed = changed_buckets(before, after, bucket)
    mark = "_tw_bucket"
    b, a = (df.withColumn(mark, bucket).join(changed.select(F.col("bucket").alias(mark)), mark, "left_semi").drop(mark)
            for df in (before, after.select(*before.columns)))
    return snapshot_diff(b, a, keys)


def changed_buckets(before: DataFrame, after: DataFrame, bucket: Column) -> DataFrame:
    """``(bucket)`` for the buckets that the two sides do not share."""
    b, a = (bucket_digests(df, bucket).withColumnRenamed("digest", name)
            for df, name in ((before, "_b"), (after.select(*before.columns), "_a")))
    return b.join(a, "bucket", "full_outer").filter(~F.col("_b").eqNullSafe(F.col("_a"))).select("bucket")


def _quote(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def restore_version(feed: DataFrame, keys: Sequence[str], version: int,
                    current_version: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``RESTORE TABLE TO VERSION AS OF n``: the old state, plus the compensating changes."""
    old = as_of_version(feed, keys, version)
    cur = as_of_version(feed, keys, current_version)
    return old, snapshot_diff(cur, old, keys)


def version_diff(feed: DataFrame, keys: Sequence[str], newer: int, older: int) -> DataFrame:
    """Rows of version ``newer`` that were not in version ``older`` (``EXCEPT``)."""
    return as_of_version(feed, keys, newer).subtract(as_of_version(feed, keys, older))


def commit_summary(feed: DataFrame) -> DataFrame:
    """What each commit did: rows per change type (``DESCRIBE HISTORY`` metrics)."""
    return (feed.groupBy(CV, CTS).pivot(CT, CHANGE_TYPES).agg(F.count(F.lit(1)))
            .na.fill(0, CHANGE_TYPES))


def store_feed(feed: DataFrame, path: str) -> str:
    """Write a change feed partitioned by version, so that reads of some versions prune the rest."""
    feed.hint("rebalance", CV).write.mode("overwrite").partitionBy(CV).parquet(path)
    return path
