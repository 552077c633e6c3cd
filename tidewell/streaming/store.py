"""Table state for streaming upserts on plain Parquet (no table-format jar).

``VersionedTable`` keeps a keyed table as versions of buckets:

    <path>/state/_tw_version=<n>/_tw_bucket=<b>/part-*.parquet   rows of bucket b as of version n
    <path>/manifest/_tw_version=<n>/…                            (bucket, version directory) of every bucket
                                                                 with rows as of version n: the commit marker
    <path>/changes/_commit_version=<n>/…                         change rows of that commit

A commit reads only the buckets its source rows fall into, applies a pure function
``(current_rows, source) -> MergeResult``, writes those buckets under a new version
directory and the change rows into a folder nobody reads, then the manifest, and
last moves the change rows to their place.  A version whose manifest exists is
never written again: a replayed ``foreachBatch`` epoch only finishes a move that
was cut off, so a stream over ``changes`` sees every change row once.  (The move is
one rename, atomic on file systems that have renames.)

A read takes the newest manifest up to the version asked for and opens the directories
that it names and no other, so its cost does not grow with the number of versions.  A
restore is a manifest that names the directories of an earlier version, with the
compensating change rows: it writes no state row.

Buckets are hashes of the keys unless ``bucket_by`` names an expression of the key
columns: with one that follows the arrival order (a day, a month) a batch rewrites
only the buckets it is local in.

``EpochTable`` is the complete-mode sink: each epoch's full result goes to its
own directory and readers take the newest.
"""

from __future__ import annotations

import json
from typing import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidewell.operators.changes import CTS, CV, snapshot_diff
from tidewell.operators.layout import input_bytes
from tidewell.operators.merge import MergeResult
from tidewell.session import list_names, move_path, path_exists

# partition columns of the layout (named so they cannot clash with table columns)
V, B = "_tw_version", "_tw_bucket"
AT = "_tw_at"       # in a manifest: the version directory that holds a bucket
KIND = "_tw_is_state"


BUCKET_BYTES = 128 << 20
CODEC = "zstd"      # of state and change rows


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int | None = None,
                 bucket_by: str | None = None):
        """``buckets``: number of hash buckets; by default it follows the size given to
        ``create``.  ``bucket_by``: SQL over key columns giving the bucket number instead."""
        self.spark, self.path, self.keys, self.bucket_by = spark, path.rstrip("/"), list(keys), bucket_by
        self._buckets = buckets
        self._schema: StructType | None = None

    # ---- layout ------------------------------------------------------------------
    @property
    def buckets(self) -> int:
        if self._buckets is None:
            self.schema()
        return self._buckets

    def bucket_of(self) -> "F.Column":
        if self.bucket_by is not None:
            return F.coalesce(F.expr(self.bucket_by).cast("int"), F.lit(-1))
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _committed_versions(self) -> list[int]:
        """Versions that have a manifest folder, newest first."""
        names = list_names(self.spark, f"{self.path}/manifest")
        return sorted((int(n.split("=")[1]) for n in names if n.startswith(f"{V}=")), reverse=True)

    def committed(self, version: int) -> bool:
        """Whether the version's manifest, one file, is in its place."""
        return any(n.startswith("part-") for n in list_names(self.spark, f"{self.path}/manifest/{V}={version}"))

    def latest_version(self, up_to: int | None = None) -> int | None:
        """The newest committed version (not above ``up_to``)."""
        return next((v for v in self._committed_versions() if (up_to is None or v <= up_to) and self.committed(v)), None)

    def _live(self, version: int | None) -> dict[int, int]:
        """The version directory of every bucket with rows: two integers a bucket, as in Spark's own file index."""
        v = self.latest_version(version)
        if v is None:
            return {}
        return {r[B]: r[AT] for r in self.spark.read.parquet(f"{self.path}/manifest/{V}={v}").select(B, AT).collect()}

    def _rows(self, live: dict[int, int]) -> DataFrame:
        """Rows of the named buckets, from their own directories only."""
        if not live:
            return self.spark.createDataFrame([], self.schema())
        full = StructType([*self.schema().fields, StructField(V, IntegerType()), StructField(B, IntegerType())])
        state = f"{self.path}/state"
        paths = [f"{state}/{V}={at}/{B}={b}" for b, at in sorted(live.items())]
        return self.spark.read.schema(full).option("basePath", state).parquet(*paths).drop(V, B)

    # ---- API ------------------------------------------------------------------------
    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/schema")

    def create(self, df: DataFrame, expected_bytes: int | None = None) -> None:
        """Version 0: every bucket of ``df`` (overwrites an earlier create).

        ``expected_bytes`` is the size the table will have (by default that of ``df``); the
        bucket count follows it.  The schema is stored next to the data, so an empty
        table has one too.
        """
        if self._buckets is None:
            self._buckets = max(8, -(-(expected_bytes or input_bytes(df)) // BUCKET_BYTES))
        self._schema = df.schema
        meta = json.dumps({"schema": df.schema.jsonValue(), "buckets": self._buckets})
        (self.spark.createDataFrame([(meta,)], "value string").coalesce(1)
         .write.mode("overwrite").text(f"{self.path}/schema"))
        self._write(0, df, None, {})

    def ensure(self, df: DataFrame, expected_bytes: int | None = None) -> "VersionedTable":
        """``create`` unless the table is there already."""
        if not self.exists():
            self.create(df, expected_bytes)
        return self

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of ``version`` (default: now)."""
        return self._rows(self._live(version))

    def read_buckets_of(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The buckets that the rows of ``keys`` (with the key columns) fall into, whole."""
        wanted = self._buckets_of(keys)
        return self._rows({b: at for b, at in self._live(version).items() if b in wanted})

    def _buckets_of(self, source: DataFrame) -> set[int]:
        return {r[0] for r in source.select(self.bucket_of().alias(B)).distinct().collect()}  # one integer per bucket

    def schema(self) -> StructType:
        if self._schema is None:
            meta = json.loads(self.spark.read.text(f"{self.path}/schema").first()[0])
            self._schema, self._buckets = StructType.fromJson(meta["schema"]), meta["buckets"]
        return self._schema

    def changes(self, start: int | None = None, end: int | None = None) -> DataFrame:
        """Change rows of committed versions."""
        ch = self.spark.read.parquet(f"{self.path}/changes")    # only committed versions are moved here
        if start is not None:
            ch = ch.filter(F.col(CV) >= start)
        if end is not None:
            ch = ch.filter(F.col(CV) <= end)
        return ch

    def commit(self, version: int, source: DataFrame,
               apply: Callable[[DataFrame, DataFrame], MergeResult],
               commit_ts: "F.Column | None" = None) -> None:
        """Apply ``apply(current_rows_of_touched_buckets, source)`` as ``version``, once."""
        if self.committed(version):
            self._publish(version)
            return
        touched = self._buckets_of(source)
        if not touched:
            return
        live = self._live(version - 1)
        result = apply(self._rows({b: at for b, at in live.items() if b in touched}), source)
        self._write(version, result.state, result.changes, {b: at for b, at in live.items() if b not in touched}, commit_ts)

    def restore(self, to_version: int, version: int, commit_ts: "F.Column | None" = None) -> None:
        """Commit the state as of ``to_version`` as ``version``, once.

        The new manifest names the old directories, so no state row is written.  Buckets that
        the two versions share are not read; the others give the compensating change rows,
        which a stream over ``changes`` sees like those of any commit.
        """
        if self.committed(version):
            self._publish(version)
            return
        if self.latest_version(to_version) is None or to_version >= version:
            raise ValueError(f"no version {to_version} before {version} to restore")
        now, then = self._live(version - 1), self._live(to_version)
        moved = {b for b in {*now, *then} if now.get(b) != then.get(b)}
        before, after = (self._rows({b: at for b, at in live.items() if b in moved}) for live in (now, then))
        ts = commit_ts if commit_ts is not None else F.current_timestamp()
        (snapshot_diff(before, after, self.keys).withColumn(CTS, ts)
         .write.mode("overwrite").parquet(f"{self.path}/pending/{CV}={version}"))
        self._write_manifest(version, then)
        self._publish(version)

    def _publish(self, version: int) -> None:
        """Move the change rows of a committed version to where they are read."""
        pending, final = (f"{self.path}/{d}/{CV}={version}" for d in ("pending", "changes"))
        if path_exists(self.spark, pending) and not path_exists(self.spark, final):
            move_path(self.spark, pending, final)

    def _write(self, version: int, state: DataFrame, changes: DataFrame | None, kept: dict[int, int],
               commit_ts: "F.Column | None" = None) -> None:
        """``kept``: the buckets that stay as they are; ``state`` has the rows of all others."""
        st = state.withColumn(B, self.bucket_of())
        both = None
        if changes is not None:
            # state and change rows come from the same MERGE joins: compute them once,
            # keep them (spilling to disk; lost blocks are recomputed from lineage)
            # and write each part from that
            ts = commit_ts if commit_ts is not None else F.current_timestamp()
            ch = changes.withColumn(CTS, ts)
            both = (st.withColumn(KIND, F.lit(True))
                    .unionByName(ch.withColumn(KIND, F.lit(False)), allowMissingColumns=True)
                    .persist(StorageLevel.MEMORY_AND_DISK))
            st = both.filter(F.col(KIND)).select(*st.columns)
            ch = both.filter(~F.col(KIND)).select(*ch.columns)
        # rows go to write tasks by bucket, so each task writes few bucket folders;
        # adaptive execution splits a bucket holding a hot key into advisory-size
        # partitions instead of writing it from one task
        folder = f"{self.path}/state/{V}={version}"
        st.hint("rebalance", B).write.mode("overwrite").partitionBy(B).parquet(folder, compression=CODEC)
        if both is not None:
            ch.write.mode("overwrite").parquet(f"{self.path}/pending/{CV}={version}", compression=CODEC)
            both.unpersist()
        # a bucket without rows has no folder and no entry
        written = [int(n.split("=")[1]) for n in list_names(self.spark, folder) if n.startswith(f"{B}=")]
        self._write_manifest(version, {**kept, **{b: version for b in written}})
        if both is not None:
            self._publish(version)

    def _write_manifest(self, version: int, live: dict[int, int]) -> None:
        pairs = self.spark.createDataFrame(sorted(live.items()), f"{B} int, {AT} int")
        pairs.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{V}={version}")


class EpochTable:
    """Complete-mode sink: one directory per epoch, readers take the newest."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")

    def read(self) -> DataFrame:
        df = self.spark.read.parquet(self.path)
        last = df.select(F.max("epoch")).first()[0]
        return df.filter(F.col("epoch") == last).drop("epoch")
