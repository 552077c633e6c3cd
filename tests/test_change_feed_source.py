import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewell.operators.cdc import cdc_apply
from tidewell.operators.changes import CV, changes_between, store_feed
from tidewell.session import scratch_path
from tidewell.sources.change_feed import SPLIT_BYTES, _Folder, register_change_feed
from tidewell.streaming.runner import run_available_now
from tidewell.streaming.store import VersionedTable

DDL = f"id INT, `a b` STRING, d DECIMAL(9,2), at TIMESTAMP, l ARRAY<STRUCT<x: INT, y: STRING>>, _change_type STRING, {CV} BIGINT"


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def _feed(spark, versions):
    ts = dt.datetime(2024, 5, 1, 12, 30, 0, 123456)
    data = [(i, None if i % 3 else f"ü{i}", None, ts, [(i, "y"), None] if i % 2 else None, "insert", v)
            for v in versions for i in range(v * 10)]
    return spark.createDataFrame(data, DDL)


def _source(spark, path, first=None, last=None, split=None, stream=False):
    register_change_feed(spark)
    r = (spark.readStream if stream else spark.read).format("change_feed")
    for k, v in (("startingVersion", first), ("endingVersion", last), ("splitBytes", split)):
        if v is not None:
            r = r.option(k, v)
    return r.load(path)


def test_batches_equal_the_filter_form(spark):
    path = store_feed(_feed(spark, [1, 2, 5, 12]), scratch_path(spark, "feed"))
    feed = spark.read.parquet(path).withColumn(CV, F.col(CV).cast("long"))
    assert dict(_source(spark, path).dtypes) == dict(feed.dtypes)
    for first, last in ((None, None), (2, None), (2, 5), (3, 4), (None, 1), (99, None)):
        expect = rows(changes_between(feed, first if first is not None else 0, last))
        assert rows(_source(spark, path, first, last)) == expect, (first, last)
    assert rows(_source(spark, path).select("a b", CV)) == rows(feed.select("a b", CV))


def test_splits_read_each_row_group_once(spark):
    path = scratch_path(spark, "feed-split")
    big = spark.range(20000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"), F.lit(3).alias(CV))
    big.coalesce(1).write.option("parquet.block.size", 60_000).partitionBy(CV).parquet(path)
    folder = _Folder(path)
    parts = folder.plan(folder.versions(), 50_000)
    assert len(parts) > 5 and folder.open(folder.files(3)[0][0]).metadata.num_row_groups > 1
    got = _source(spark, path, split=50_000)
    assert got.rdd.getNumPartitions() == len(parts) and rows(got.select("id")) == rows(big.select("id"))
    # small files share a task; only the versions asked for are planned
    many = store_feed(_feed(spark, range(1, 9)), scratch_path(spark, "feed-many"))
    folder = _Folder(many)
    assert len(folder.plan(folder.versions(), SPLIT_BYTES)) == 1
    assert {p[1] for part in folder.plan(folder.versions(3, 4), SPLIT_BYTES) for p in part.pieces} == {3, 4}


def test_columns_by_schema_and_missing_ones(spark):
    path = scratch_path(spark, "feed-grown")
    spark.createDataFrame([(1, 1)], f"id INT, {CV} INT").write.partitionBy(CV).parquet(path)
    spark.createDataFrame([(2, "n", 2)], f"id INT, note STRING, {CV} INT").write.mode("append").partitionBy(CV).parquet(path)
    assert rows(_source(spark, path)) == sorted(map(str, spark.createDataFrame(
        [(1, 1, None), (2, 2, "n")], f"{CV} LONG, id INT, note STRING").collect()))
    register_change_feed(spark)
    one = spark.read.format("change_feed").schema(f"{CV} LONG").load(path)
    assert sorted(r[0] for r in one.collect()) == [1, 2]
    empty = scratch_path(spark, "feed-none")
    assert spark.read.format("change_feed").schema("id INT").load(empty).count() == 0
    with pytest.raises(Exception, match="holds no version"):
        _source(spark, empty).count()
    with pytest.raises(Exception, match="must be a version number"):
        _source(spark, path, first="soon").count()


def test_a_stream_reads_each_version_once(spark):
    schema = "id INT, name STRING, seq INT, row_status STRING"
    table = VersionedTable(spark, scratch_path(spark, "followed-table"), ["id"])
    table.create(spark.createDataFrame([], schema), 1)
    out, ckpt = scratch_path(spark, "streamed"), scratch_path(spark, "checkpoint-streamed")
    commits = [[(1, "a", 1, "x"), (2, "b", 1, "x")], [(1, "A", 2, "x"), (2, None, 2, "delete")], [(3, "c", 3, "x")]]
    for v, source in enumerate(commits, 1):
        table.commit(v, spark.createDataFrame(source, schema), lambda cur, s: cdc_apply(cur, s, ["id"], "seq"))
        for _ in range(2):          # the second run finds nothing new
            run_available_now(_source(spark, f"{table.path}/changes", first=2, stream=True), "streamed", path=out, checkpoint=ckpt)
    got = spark.read.parquet(out)
    expect = table.changes(2).withColumn(CV, F.col(CV).cast("long"))
    assert rows(got) == rows(expect) and got.count() == 4
