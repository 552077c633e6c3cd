"""Tombstones that expire: bounded memory, no revived key, nothing lost, replays without effect."""
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidewell.session import scratch_path
from tidewell.streaming.tombstones import ExpiringApply
from conftest import rows

DDL = "id INT, val STRING, at TIMESTAMP, gone BOOLEAN"
START = datetime(2024, 1, 1)


def _kept(spark, horizon="5 days"):
    schema = spark.createDataFrame([], DDL).drop("gone").schema
    return ExpiringApply(spark, scratch_path(spark, "kept"), schema, ["id"], "at", "gone", horizon)


def _row(i, day, gone=False):
    return (i, f"v{i}-{day}", START + timedelta(days=day), gone)


def test_no_late_row_revives_a_key_and_memory_is_bounded(spark):
    rng, kept, seen = random.Random(7), _kept(spark), []
    for version in range(1, 6):
        # every batch: its own two days, and rows up to four days behind the newest
        batch = [_row(rng.randrange(12), round(2 * version + rng.uniform(-2, 2), 3), rng.random() < 0.4) for _ in range(25)]
        seen += batch
        kept.apply(spark.createDataFrame(batch, DDL), version)
        newest = {}
        for r in sorted(seen, key=lambda r: r[2]):
            newest[r[0]] = r
        assert rows(kept.read()) == sorted(r[:3] for r in newest.values() if not r[3]), version
        assert len(kept.tombstone_days()) <= 5 + 2 + 4
    assert kept.late().count() == 0
    newest_day = max(r[2] for r in seen).toordinal() - datetime(1970, 1, 1).toordinal()
    assert kept.tombstone_days()[0] >= newest_day - 10    # horizon, delay of the mark by a batch, whole days


def test_rows_behind_the_horizon(spark):
    kept = _kept(spark)
    kept.apply(spark.createDataFrame([_row(1, 0), _row(2, 0), _row(3, 1, True), _row(4, 20), (5, "no time", None, False)], DDL), 1)
    late = [_row(1, 3),             # has an older live row: applied
            _row(2, 2, True),       # likewise deleted
            _row(3, 0), _row(6, 1),   # no live row, nothing known: set aside
            _row(4, 2),             # older than the live row: ignored
            _row(7, 1, True)]       # a delete of nothing: no effect, not remembered
    kept.apply(spark.createDataFrame(late, DDL), 2)
    assert [r[:2] for r in rows(kept.read())] == [(1, "v1-3"), (4, "v4-20")]
    assert [r[:2] for r in rows(kept.late())] == [(3, "v3-0"), (6, "v6-1")]
    assert rows(kept.tombstones(), "id") == []


def test_replayed_and_empty_batches(spark):
    kept = _kept(spark)
    first = spark.createDataFrame([_row(1, 0), _row(2, 1, True)], DDL)
    kept.apply(first, 1)
    kept.apply(first.limit(0), 2)
    kept.apply(spark.createDataFrame([_row(2, 0.5), _row(2, 1), _row(3, 1)], DDL), 3)    # as old as the delete: blocked
    before = rows(kept.read()), rows(kept.tombstones()), kept.table.latest_version()
    kept.apply(first, 1)
    assert (rows(kept.read()), rows(kept.tombstones()), kept.table.latest_version()) == before
    assert [r[0] for r in before[0]] == [1, 3]
    kept.apply(spark.createDataFrame([_row(2, 2)], DDL), 4)      # newer than the delete: comes back
    assert rows(kept.read(), "id") == [(1,), (2,), (3,)]


def test_further_columns_of_a_batch_are_ignored(spark):
    kept = _kept(spark)
    kept.apply(spark.createDataFrame([_row(1, 0)], DDL).withColumn("_tw_seq", F.lit(1)), 1)
    assert kept.read().columns == ["id", "val", "at"] and kept.read().count() == 1
