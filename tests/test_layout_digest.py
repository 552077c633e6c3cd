import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewell.operators import changes as C
from tidewell.operators import layout as L
from tidewell.session import scratch_path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)

DDL = "id INT, a INT, b INT"


def _sides():
    rng = random.Random(3)
    before = {i: (i, rng.choice([None, 1, 2]), rng.choice([None, 1, 2])) for i in range(400)}
    after = dict(before)
    after[17] = (17, None, 1)
    before[17] = (17, 1, None)               # the same values in other places
    del after[33]
    after[900] = (900, 1, 1)
    return list(before.values()), list(after.values())


@pytest.mark.parametrize("how", [{}, {"buckets": 1}, {"bucket_by": "id DIV 10"}])
def test_digest_diff_equals_plain_diff(spark, how):
    before, after = (spark.createDataFrame(side, DDL) for side in _sides())
    expect = rows(C.snapshot_diff(before, after, ["id"]))
    assert expect and rows(C.snapshot_diff_by_digest(before, after, ["id"], **how)) == expect
    assert C.snapshot_diff_by_digest(before, before, ["id"], **how).count() == 0
    none = before.limit(0)
    assert C.snapshot_diff_by_digest(none, none, ["id"], **how).count() == 0
    assert C.snapshot_diff_by_digest(none, after, ["id"], **how).count() == len(_sides()[1])


def test_only_changed_buckets_are_joined(spark):
    before, after = (spark.createDataFrame(side, DDL) for side in _sides())
    assert rows(C.changed_buckets(before, after, F.expr("id DIV 10"))) == [(1,), (3,), (90,)]
    # order does not matter, and rows given twice do not cancel out
    twice = before.unionByName(before.filter("id < 10")).unionByName(before.filter("id < 10"))
    assert rows(C.changed_buckets(before, before.orderBy(F.desc("id")), F.expr("id DIV 10"))) == []
    assert rows(C.changed_buckets(before, twice, F.expr("id DIV 10"))) == [(0,)]


def _groups_read(path, column, lo, hi):
    """Row groups whose statistics meet the range."""
    n = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            n += s.min <= hi and s.max >= lo
    return n


def test_ranks_beat_linear_scaling_on_skewed_columns(spark):
    # numbers: nearly all small with a far outlier; strings: one long common prefix
    df = spark.range(20000).select(
        F.when(F.col("id") == 7, F.lit(10**12)).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000))).alias("n"),
        F.concat(F.lit("https://example.org/"), F.lpad(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5000)).cast("string"), 5, "0")).alias("url"),
        F.col("id"))
    read = {}
    for by in ("linear", "rank"):
        path = scratch_path(spark, f"clustered-{by}")
        L.layout_rewrite(df, path, ["n", "url"], files=16, by=by)
        assert spark.read.parquet(path).exceptAll(df).count() == 0 and spark.read.parquet(path).count() == 20000
        read[by] = (sum(_groups_read(path, "n", lo, lo + 50) for lo in range(0, 5000, 500)),
                    sum(_groups_read(path, "url", f"https://example.org/{lo:05d}", f"https://example.org/{lo + 50:05d}") for lo in range(0, 5000, 500)))
    assert 2 * read["rank"][0] <= read["linear"][0] and 2 * read["rank"][1] <= read["linear"][1], read


def test_rank_key_of_odd_columns(spark):
    df = spark.createDataFrame([(None, "a"), (1.0, None), (1.0, "a"), (float("nan"), "é"), (-0.0, "")], "x double, `s t` string")
    assert df.select(L.rank_zorder_key(df, ["x", "s t"]).alias("k")).filter("k IS NULL OR k < 0").count() == 0
    empty = df.limit(0)
    assert L.rank_boundaries(empty, ["x"]) == {"x": []}
    assert empty.select(L.rank_zorder_key(empty, ["x", "s t"])).count() == 0
    ordered = spark.range(1000).select(L.rank_zorder_key(spark.range(1000), ["id"]).alias("k"), "id")
    assert [r["id"] for r in ordered.orderBy("k", "id").collect()] == list(range(1000))


@pytest.mark.parametrize("cols, by", [(["id"], "linear"), (["id", "s"], "linear"), (["id", "s"], "rank")])
def test_rows_of_a_file_are_bounded_in_memory(spark, monkeypatch, cols, by):
    # rows that compress to nearly nothing: by file sizes alone all of them would be one sort
    df = spark.range(20000).select("id", F.lit("x" * 100).alias("s"))
    monkeypatch.setattr(L, "SORT_BYTES", 400_000)
    path = scratch_path(spark, "bounded")
    L.layout_rewrite(df, path, cols, by=by)
    out = spark.read.parquet(path)
    assert out.exceptAll(df).count() == 0 and out.count() == 20000
    sizes = [r["count"] for r in out.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 20000 / 4


def test_sort_bytes_of_odd_columns(spark):
    df = spark.createDataFrame([(1, None, [1, 2], {"a": "b"}, b"xyz"), (None, "é" * 1000, None, {}, None)],
                               "n int, `s t.u` string, a array<int>, m map<string,string>, b binary")
    assert 2000 < L.sort_bytes(df) < 3000 and L.sort_bytes(df.limit(0)) == 0
