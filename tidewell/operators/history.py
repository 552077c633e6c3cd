"""Change feeds stored by version, with snapshots that as-of reads start from.

    <path>/feed/_commit_version=<n>/…     change rows of one commit
    <path>/snapshots/_snapshot=<n>/…      the table's rows as of version n

``as_of(n)`` opens the newest snapshot not above n and replays only the feed partitions after it,
so a read costs the table plus the commits since that snapshot, however long the history is.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F, types as T

from tidewell.operators.changes import CT, CTS, CV, as_of_version
from tidewell.session import list_names

SNAP = "_snapshot"


class FeedHistory:
    """A change feed (table columns, ``_change_type``, ``_commit_version``, ``_commit_timestamp``) and its snapshots.

    A version's change rows replace those it had, so a repeated ``append`` adds nothing; one that
    would change versions a snapshot already covers is refused.  Null keys are keys like any other.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    def append(self, feed: DataFrame) -> None:
        first, covered = feed.agg(F.min(CV)).first()[0], self.snapshots()
        if first is None:
            return
        if covered and first <= covered[-1]:
            raise ValueError(f"version {first} is covered by the snapshot of version {covered[-1]}")
        (feed.hint("rebalance", CV).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(CV).parquet(f"{self.path}/feed"))

    def feed(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/feed")

    def snapshots(self) -> list[int]:
        """Versions with a complete snapshot, ascending (one folder name each)."""
        root = f"{self.path}/snapshots"
        found = sorted(int(n.split("=")[1]) for n in list_names(self.spark, root) if n.startswith(f"{SNAP}="))
        return [v for v in found if "_SUCCESS" in list_names(self.spark, f"{root}/{SNAP}={v}")]

    def snapshot(self, version: int) -> None:
        """Store the rows as of ``version``, unless they are stored."""
        if version not in self.snapshots():
            out = f"{self.path}/snapshots/{SNAP}={version}"
            self.as_of(version).write.mode("overwrite").option(
                "mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(out)

    def snapshot_every(self, versions: int) -> list[int]:
        """Store a snapshot wherever ``versions`` commits have passed since the one before; return them.
        Each is built on the last, so every commit is replayed once."""
        have = self.snapshots()
        last = self.feed().agg(F.min(CV).alias("lo"), F.max(CV).alias("hi")).first()
        if last["hi"] is None:
            return have
        at = (have[-1] if have else last["lo"] - 1) + versions
        while at <= last["hi"]:
            self.snapshot(at)
            at += versions
        return self.snapshots()

    def as_of(self, version: int) -> DataFrame:
        """The table's rows as of ``version``: the newest snapshot up to it and the changes since."""
        base = max((v for v in self.snapshots() if v <= version), default=None)
        feed = self.feed().filter(F.col(CV) <= version)
        if base is None:
            return as_of_version(feed, self.keys)
        # constant bounds on the partition column: other versions' folders are not listed into the scan
        since = feed.filter((F.col(CV) > base) & (F.col(CT) != "update_preimage"))
        data = [c for c in feed.columns if c not in self.keys and c not in (CT, CV, CTS)]
        schema = T.StructType([f for f in feed.schema.fields if f.name not in (CT, CV, CTS)])
        stored = self.spark.read.schema(schema).parquet(f"{self.path}/snapshots/{SNAP}={base}")
        last = since.groupBy(*self.keys).agg(
            F.max_by(F.struct(*[F.col(c) for c in data], F.col(CT)), F.col(CV)).alias("_r"))
        changed = last.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)])
        kept = stored.join(changed, same, "left_anti").select(*self.keys, *data)
        now = last.filter(F.col(f"_r.{CT}") != "delete").select(*self.keys, *[F.col(f"_r.{c}").alias(c) for c in data])
        return kept.unionByName(now)
