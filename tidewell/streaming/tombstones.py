"""``APPLY CHANGES`` whose memory of deleted keys ends after a horizon.

``ExpiringApply`` keeps the live rows in a ``VersionedTable`` and the deletes beside them:

    <path>/live/…                                            live rows, no tombstones among them
    <path>/tombstones/_tw_day=<d>/_tw_version=<n>/…          keys and sequence of the deletes of batch n
    <path>/late/_tw_version=<n>/…                            rows of batch n that nothing can decide any more
    <path>/marks/_tw_version=<n>                             the greatest sequence up to batch n

A row is applied to a live row when it is newer than that.  A row without a live row
is inserted unless a delete at or after its sequence is remembered.  Deletes are
remembered while they are less than ``horizon`` older than the greatest sequence of the
batches before, so a row without a live row that is older than the horizon can no longer
be told from a row that was deleted: it is not inserted but kept under ``late``.

Days of deletes behind the horizon are removed as whole folders, whichever keys a batch
mentions, so the memory is bounded by the deletes of one horizon; a batch opens only the days from its own smallest
sequence on, because an older delete blocks none of its rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampType

from tidewell.operators.merge import Delete, Insert, MergeResult, Update, merge_into
from tidewell.operators.window import latest_per_key
from tidewell.session import list_names, remove_path
from tidewell.streaming.store import V, VersionedTable

DAY = "_tw_day"
GONE, BLOCKED = "_tw_gone", "_tw_blocked"
SEQ = "_tw_seq"
DAY_MICROS = 86_400_000_000


class ExpiringApply:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], sequence_by: str,
                 delete_when: str, horizon: str):
        """``schema``: the columns of the table, keys and ``sequence_by`` (a timestamp) among them; a batch may
        have more.  ``delete_when``: SQL over a batch row (null is no delete).  ``horizon``: an interval such as
        ``"10 days"``.  Rows without a sequence are ignored, as in ``APPLY CHANGES``; null keys equal nothing."""
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.seq, self.delete_when, self.horizon = list(keys), sequence_by, delete_when, horizon
        self.columns = schema.names
        if not isinstance(schema[sequence_by].dataType, TimestampType):
            raise ValueError(f"{sequence_by} must be a timestamp")
        self._tombstone_schema = StructType([*[schema[k] for k in self.keys], StructField(SEQ, TimestampType()),
                                             StructField(DAY, IntegerType()), StructField(V, IntegerType())])
        self.table = VersionedTable(spark, f"{self.path}/live", keys).ensure(spark.createDataFrame([], schema), 1)

    # ---- what is stored ------------------------------------------------------------
    def read(self) -> DataFrame:
        return self.table.read()

    def tombstone_days(self) -> list[int]:
        """Days since 1970 that have deletes: at most those of one horizon and the day it begins in."""
        return sorted(int(n.split("=")[1]) for n in list_names(self.spark, f"{self.path}/tombstones")
                      if n.startswith(f"{DAY}="))

    def tombstones(self, first_day: int | None = None) -> DataFrame:
        days = [d for d in self.tombstone_days() if first_day is None or d >= first_day]
        if not days:
            return self.spark.createDataFrame([], self._tombstone_schema).drop(DAY, V)
        root = f"{self.path}/tombstones"
        return (self.spark.read.schema(self._tombstone_schema).option("basePath", root)
                .parquet(*[f"{root}/{DAY}={d}" for d in days]).drop(DAY, V))

    def late(self) -> DataFrame:
        """Rows set aside, with the batch they came in (``_tw_version``)."""
        schema = StructType([*self.table.schema().fields, StructField(V, IntegerType())])
        if not list_names(self.spark, f"{self.path}/late"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/late")

    def _mark_before(self, version: int) -> int | None:
        """The greatest sequence of earlier batches, in microseconds."""
        earlier = [int(n.split("=")[1]) for n in list_names(self.spark, f"{self.path}/marks") if n.startswith(f"{V}=")]
        earlier = [v for v in earlier if v < version]
        if not earlier:
            return None
        row = self.spark.read.text(f"{self.path}/marks/{V}={max(earlier)}").first()
        return int(row[0])

    # ---- one batch ------------------------------------------------------------------
    def apply(self, batch: DataFrame, version: int) -> None:
        """Apply a micro-batch as ``version`` (1, 2, …), once: a replayed batch changes nothing.

        The deletes, late rows and mark of a version are written before its live rows are committed, in folders
        of their own that a repeated attempt replaces, so a cut-off attempt leaves nothing behind."""
        if self.table.committed(version):
            self.table.commit(version, batch, None)    # only finishes a cut-off publication
            return
        src = latest_per_key(batch.filter(F.col(self.seq).isNotNull())
                             .withColumn(GONE, F.coalesce(F.expr(self.delete_when), F.lit(False))), self.keys, self.seq)
        src = src.select(*self.columns, GONE)
        lo, hi = src.agg(F.min(F.unix_micros(self.seq)), F.max(F.unix_micros(self.seq))).first()
        if lo is None:
            return
        mark = self._mark_before(version)
        floor = None
        if mark is not None:
            floor = self.spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(mark)) - F.expr(f"INTERVAL {self.horizon}"))).first()[0]
        in_time = F.lit(True) if floor is None else F.unix_micros(self.seq) >= F.lit(floor)

        self._write_tombstones(src.filter(F.col(GONE) & in_time), version)
        if floor is not None and lo < floor:
            behind = src.filter(~F.col(GONE) & ~in_time)
            live = self.table.read_buckets_of(behind, version - 1).select(*self.keys)
            (behind.join(live, self.keys, "left_anti").select(*self.columns)
             .write.mode("overwrite").parquet(f"{self.path}/late/{V}={version}"))
        (self.spark.createDataFrame([(str(max(hi, mark or hi)),)], "value string").coalesce(1)
         .write.mode("overwrite").text(f"{self.path}/marks/{V}={version}"))

        last_delete = self.tombstones(lo // DAY_MICROS).groupBy(*self.keys).agg(F.max(SEQ).alias(SEQ))
        src = (src.join(last_delete, self.keys, "left")
               .withColumn(BLOCKED, ~in_time | F.coalesce(F.col(SEQ) >= F.col(self.seq), F.lit(False))).drop(SEQ))
        self.table.commit(version, src, self._merge)
        self._expire(floor, version)

    def _merge(self, live: DataFrame, src: DataFrame) -> MergeResult:
        newer = F.col(f"t.{self.seq}") < F.col(f"s.{self.seq}")
        return merge_into(live, src, self.keys,
                          matched=[Delete(F.col(f"s.{GONE}") & newer), Update(~F.col(f"s.{GONE}") & newer)],
                          not_matched=[Insert(~F.col(f"s.{GONE}") & ~F.col(f"s.{BLOCKED}"))],
                          check_cardinality=False)    # one source row a key by construction

    def _write_tombstones(self, deletes: DataFrame, version: int) -> None:
        (deletes.select(*self.keys, F.col(self.seq).alias(SEQ),
                        F.floor(F.unix_micros(self.seq) / F.lit(DAY_MICROS)).cast("int").alias(DAY), F.lit(version).alias(V))
         .hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(DAY, V).parquet(f"{self.path}/tombstones"))

    def _expire(self, floor: int | None, version: int) -> None:
        """Remove whole days behind the horizon and marks that no batch asks for any more."""
        if floor is not None:
            for day in self.tombstone_days():
                if (day + 1) * DAY_MICROS <= floor:
                    remove_path(self.spark, f"{self.path}/tombstones/{DAY}={day}")
        for name in list_names(self.spark, f"{self.path}/marks"):
            if name.startswith(f"{V}=") and int(name.split("=")[1]) < version:
                remove_path(self.spark, f"{self.path}/marks/{name}")
