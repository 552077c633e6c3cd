import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewell.operators.merge import merge_insert_only
from tidewell.session import scratch_path
from tidewell.streaming.runner import land_files, run_available_now
from tidewell.streaming.stateful import stream_dedup, tumbling_stats
from tidewell.streaming.store import EpochTable, VersionedTable
from conftest import SF_SMALL, rows


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def test_tumbling_stream_matches_batch_twin(spark):
    e = _events(spark)
    path = land_files(e, "parquet", "t-events", files_per_chunk=2)
    s = spark.readStream.schema(e.schema).parquet(path)
    out = spark.read.parquet(run_available_now(tumbling_stats(s, "ts", ["event_type"], "event_id", "value"),
                                               "t-tumble"))
    batch = tumbling_stats(e, "ts", ["event_type"], "event_id", "value")
    cutoff = e.agg(F.max("ts")).first()[0]
    import datetime as dt
    # Z5: append mode holds back windows that end after the watermark
    closed = batch.filter(F.col("window_end") <= F.lit(cutoff - dt.timedelta(minutes=10)))
    assert rows(out) == rows(closed)
    assert out.count() < batch.count()


def test_late_rows_behind_watermark_are_dropped(spark):
    schema = "id INT, ts TIMESTAMP"
    mk = lambda data: spark.createDataFrame(data, schema)
    import datetime as dt
    t = lambda h, m=0, s=0: dt.datetime(2024, 1, 1, h, m, s)
    path = scratch_path(spark, "late")
    for part in ([(1, t(1))], [(2, t(2))], [(3, t(0, 0, 10))], [(4, t(3))]):
        land_files(mk(part), "parquet", "late", files_per_chunk=1, path=path)
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    agg = (s.withWatermark("ts", "10 minutes").groupBy(F.window("ts", "5 minutes")).agg(F.count("id").alias("n"))
           .select(F.col("window.start").alias("start"), "n"))
    out = rows(spark.read.parquet(run_available_now(agg, "late-agg")))
    # Z6: row 3 arrives after the watermark passed 01:50 and is ignored
    assert out == [(t(1), 1), (t(2), 1)]


def test_stream_dedup_and_parity(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:01:00")],
                               "id INT, ts STRING").withColumn("ts", F.col("ts").cast("timestamp"))
    path = land_files(df, "parquet", "dups", files_per_chunk=1)
    land_files(df, "parquet", "dups", files_per_chunk=1, path=path)
    s = spark.readStream.schema(df.schema).parquet(path)
    out = spark.read.parquet(run_available_now(stream_dedup(s, ["id", "ts"], "ts", "30 seconds"), "dedup"))
    assert rows(out, "id") == [(1,), (2,)]


def test_versioned_table_replay_is_idempotent(spark):
    t = VersionedTable(spark, scratch_path(spark, "vt"), ["k"], buckets=4)
    t.create(spark.createDataFrame([(i, i) for i in range(8)], "k INT, v INT"))
    src = spark.createDataFrame([(1, 100), (20, 200)], "k INT, v INT")

    def apply(cur, s):
        return merge_insert_only(cur, s, ["k"])

    t.commit(1, src, apply)
    first = rows(t.read())
    t.commit(1, src, apply)  # a re-run of the same epoch after a crash
    assert rows(t.read()) == first
    assert (20, 200) in first and len(first) == 9
    assert rows(t.read(version=0)) == [(i, i) for i in range(8)]
    assert rows(t.changes(), "k", "_change_type") == [(20, "insert")]


def test_epoch_table_reads_latest(spark):
    e = EpochTable(spark, scratch_path(spark, "et"))
    e.write(spark.createDataFrame([(1,)], "x INT"), 0)
    e.write(spark.createDataFrame([(2,), (3,)], "x INT"), 1)
    assert rows(e.read()) == [(2,), (3,)]


def test_streaming_rejects_sort_and_rank(spark):
    e = _events(spark)
    path = land_files(e.limit(10), "parquet", "neg", files_per_chunk=1)
    s = spark.readStream.schema(e.schema).parquet(path)
    with pytest.raises(PySparkException):
        run_available_now(s.orderBy("ts"), "sorted", output_mode="append")
    ranked = s.withColumn("r", F.rank().over(Window.partitionBy("user_id").orderBy("ts")))
    with pytest.raises(PySparkException):
        run_available_now(ranked, "ranked")


def test_insert_overwrite_arity(spark):
    from tidewell.operators.tables import ctas, overwrite_rows
    ctas(spark.createDataFrame([(1, "a")], "id INT, s STRING"), "arity_t")
    with pytest.raises(ValueError):
        overwrite_rows(spark.createDataFrame([(1, "a", 2)], "id INT, s STRING, extra INT"), "arity_t")


@pytest.mark.parametrize("trigger", ["available_now", "once", "1 second", None])
def test_triggers_give_the_same_rows(spark, trigger):
    """T8: available-now, once, processing-time and the default trigger all deliver
    every landed row exactly once (append mode, stateless)."""
    e = _events(spark).filter("value > 0").select("event_id", "user_id", "event_type", "value")
    path = land_files(e, "parquet", "t-trig", files_per_chunk=3)
    s = spark.readStream.schema(e.schema).parquet(path)
    out = spark.read.parquet(run_available_now(s, "t-trig-out", trigger=trigger))
    assert rows(out) == rows(e)


def test_replayed_epoch_adds_no_change_rows_to_a_running_stream(spark):
    t = VersionedTable(spark, scratch_path(spark, "vt-replay"), ["k"], buckets=4)
    t.create(spark.createDataFrame([], "k INT, v INT"))
    src = spark.createDataFrame([(i, i) for i in range(10)], "k INT, v INT")

    def apply(cur, s):
        return merge_insert_only(cur, s, ["k"])

    t.commit(1, src, apply)
    schema = spark.read.parquet(t.path + "/changes").schema
    out, ckpt = scratch_path(spark, "seen"), scratch_path(spark, "seen-ckpt")

    def follow():
        run_available_now(spark.readStream.schema(schema).parquet(t.path + "/changes"), "seen", path=out, checkpoint=ckpt)
        return spark.read.parquet(out).count()
    assert follow() == 10
    t.commit(1, src, apply)     # the same epoch again
    assert follow() == 10 and t.changes().count() == 10
    # cut off between the commit marker and the move: the replay finishes it
    from tidewell.session import move_path, path_exists
    t.commit(2, spark.createDataFrame([(50, 1)], "k INT, v INT"), apply)
    move_path(spark, t.path + "/changes/_commit_version=2", t.path + "/pending/_commit_version=2")
    t.commit(2, src, apply)
    assert follow() == 11 and not path_exists(spark, t.path + "/pending/_commit_version=2")


def test_batch_local_in_time_rewrites_only_its_buckets(spark):
    rows_ = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") / 100).cast("int").alias("day"))
    t = VersionedTable(spark, scratch_path(spark, "vt-days"), ["k", "day"], bucket_by="day")
    t.create(rows_)
    t.commit(1, spark.createDataFrame([(5000, 3), (5001, 3)], "k LONG, day INT"),
             lambda cur, s: merge_insert_only(cur, s, ["k", "day"]))
    assert spark.read.parquet(t.path + "/state/_tw_version=1").count() == 102
    assert t.read().count() == 1002 and t.read(0).count() == 1000


def test_pipeline_runs_twice_on_one_root(spark):
    """Two landings, one after the other, give what one landing of everything gives."""
    from conftest import SF_SMALL
    from tidewell.plans import pipelines as P
    root = scratch_path(spark, "twice")
    P.medallion_daily(spark, SF_SMALL, root, "order_timestamp < TIMESTAMP '1998-01-01'").count()
    twice = P.medallion_daily(spark, SF_SMALL, root, "order_timestamp >= TIMESTAMP '1998-01-01'")
    cols = ["customer_id", "f_name", "order_date", "books_counts"]
    assert rows(twice, *cols) == rows(P.medallion_daily(spark, SF_SMALL), *cols)


def test_the_envelope_lands_compressed_in_bounded_files(spark, monkeypatch):
    from tidewell.plans import stream_queries as S
    from tidewell.sources import shapes
    monkeypatch.setitem(S.LANDED, "maxRecordsPerFile", 500)
    feed = shapes.bronze_envelope(spark, SF_SMALL)
    path = S.land_envelope(spark, SF_SMALL)
    landed = spark.read.schema(shapes.ENVELOPE_DDL).json(path)
    assert landed.count() == feed.count() and landed.exceptAll(feed).count() == 0
    assert max(r["count"] for r in landed.groupBy(F.col("_metadata.file_path")).count().collect()) <= 500
    stored = sum(f.length for f in spark.read.format("binaryFile").load(path).select("length").collect())
    text = feed.select(F.sum(F.octet_length(F.to_json(F.struct(*feed.columns))))).first()[0]
    assert 2 * stored < text


def test_states_and_bronze_are_stored_small(spark):
    import glob
    import pyarrow.parquet as pq
    from tidewell.plans import stream_queries as S
    table = VersionedTable(spark, scratch_path(spark, "small-state"), ["id"])
    table.create(spark.range(3).withColumn("v", F.lit("a")))
    table.commit(1, spark.range(5).withColumn("v", F.lit("b")), lambda cur, src: merge_insert_only(cur, src, ["id"]))
    for path in (table.path + "/state", table.path + "/changes", S.build_bronze(spark, SF_SMALL)):
        files = glob.glob(f"{path}/**/part-*.parquet", recursive=True)
        groups = [m.row_group(0) for m in map(pq.read_metadata, files) if m.num_rows]    # a file may be empty
        assert {g.column(0).compression for g in groups} == {"ZSTD"}
    assert rows(table.read()) == [(0, "a"), (1, "a"), (2, "a"), (3, "b"), (4, "b")]
