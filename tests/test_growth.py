"""Growing schemas, stored snapshots, committed restores, maintained aggregates and bounded stream joins."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from tidewell.operators.cdc import cdc_apply
from tidewell.operators.changes import as_of_version, cdc_change_feed
from tidewell.operators.history import FeedHistory
from tidewell.operators.layout import expire_partitions, input_bytes
from tidewell.operators.maintain import GoldView, refresh
from tidewell.operators.merge import merge_insert_only
from tidewell.session import list_names, scratch_path
from tidewell.streaming.ingest import GrowingIngest, merge_schemas
from tidewell.streaming.joins import bounded_stream_join, stream_stream_join
from tidewell.streaming.runner import land_files
from tidewell.streaming.store import VersionedTable


# ---- ingest -----------------------------------------------------------------------------

def _ingest(spark, **kw):
    at = scratch_path(spark, "ingest")
    return f"{at}/landing", GrowingIngest(spark, f"{at}/landing", f"{at}/out", f"{at}/schema", f"{at}/ckpt", **kw)


def _drop(spark, landing, *lines):
    land_files(spark.createDataFrame([(x,) for x in lines], "value string"), "text", "drop", files_per_chunk=1, path=landing)


def test_schema_grows_and_nothing_is_lost(spark):
    landing, g = _ingest(spark)
    _drop(spark, landing, '{"id":1,"name":"x","later":null}', "", '{"id":2,"v":1.5}')
    assert g.run().columns == ["id", "name", "v", "_rescued"]
    _drop(spark, landing, '{"id":"bad","later":{"a":1,"b":[1,2]}}', "not json", "[1]", '{"ID":7,"a\\"b.c":true}')
    g.run()
    _drop(spark, landing, '{"id":"12","later":{"a":"q","c":{"d":1}}}', '{"id":3,"later":{"a":2,"b":["x",3,null]}}',
          '{"id":4,"v":"1.25","later":{"a":null,"b":[null,5]}}', '{"id":1.5,"v":true}', '{"id":9,"name":8}')
    out = g.run()
    assert out.columns == ["id", "name", "v", 'a"b.c', "later", "_rescued"] and g.log.versions() == [0, 1, 2]
    got = {(r["id"], r["name"], r["v"], r['a"b.c'], str(r["later"].asDict(True)) if r["later"] else None, r["_rescued"]) for r in out.collect()}
    assert got == {
        (1, "x", None, None, None, None), (2, None, 1.5, None, None, None),
        (None, None, None, None, "{'a': 1, 'b': [1, 2], 'c': None}", '{"id":"bad"}'),
        (None, None, None, None, None, '{"_corrupt":"not json"}'), (None, None, None, None, None, '{"_corrupt":"[1]"}'),
        (None, None, None, True, None, '{"ID":7}'),
        (12, None, None, None, "{'a': None, 'b': None, 'c': {'d': 1}}", '{"later":{"a":"q","c":{"d":1}}}'),
        (3, None, None, None, "{'a': 2, 'b': [None, 3, None], 'c': None}", '{"later":{"a":2,"b":["x",3,null]}}'),
        (4, None, 1.25, None, "{'a': None, 'b': [None, 5], 'c': None}", None),
        (None, None, None, None, None, '{"id":1.5,"v":true}'), (9, "8", None, None, None, None)}
    # a replayed micro-batch overwrites its own rows and publishes no schema
    lines = spark.read.text(landing).filter("value LIKE '%name\":8%'")
    g._batch(lines, 2)
    assert g.log.versions() == [0, 1, 2] and g.read().filter("id IN (3, 4, 12)").isEmpty() and g.read().filter("id = 9").count() == 1


def test_ingest_of_nothing_and_of_hints(spark):
    landing, g = _ingest(spark, schema_hints=T.StructType([T.StructField("id", T.StringType())]))
    _drop(spark, landing, "", " ")
    assert g.run().columns == ["id", "_rescued"] and g.run().count() == 0
    _drop(spark, landing, '{"id":1,"w":2}')
    assert rows(g.run()) == [("1", 2, None)]
    known, clash = merge_schemas(T.StructType([T.StructField("A", T.LongType())]), T.StructType([T.StructField("a", T.StringType())]))
    assert known.names == ["A"] and clash == ["a"]


# ---- snapshots and restores ------------------------------------------------------------------

def _feed(spark, n=400, seed=1):
    rnd = random.Random(seed)
    data = [(rnd.choice([None, *range(25)]), rnd.choice(["insert", "update", "delete"]), i, rnd.randint(0, 9), 100 + i // 20) for i in range(n)]
    f = spark.createDataFrame(data, "k INT, status STRING, t INT, v INT, day INT")
    return cdc_change_feed(f, ["k"], "t", "status", F.col("day"), drop=["day"])


def test_as_of_equals_full_replay_for_every_version(spark):
    feed = _feed(spark).persist()
    h = FeedHistory(spark, scratch_path(spark, "history"), ["k"])
    h.append(feed.filter("_commit_version < 113"))
    assert h.snapshot_every(4) == [103, 107, 111]
    h.append(feed.filter("_commit_version >= 113"))
    h.append(feed.filter("_commit_version >= 113"))         # delivered again
    for v in range(99, 122):
        assert sorted(map(str, h.as_of(v).collect())) == sorted(map(str, as_of_version(feed, ["k"], v).select(*h.as_of(v).columns).collect())), v
    plan = h.as_of(114)._jdf.queryExecution().executedPlan().toString()
    assert "_commit_version" in plan and "> 111" in plan and "_snapshot=111" in plan
    with pytest.raises(ValueError):
        h.append(feed.filter("_commit_version = 110"))


def _counted(spark, n=40):
    t = VersionedTable(spark, scratch_path(spark, "counted"), ["k"], buckets=4)
    t.create(spark.range(n).select(F.col("id").cast("int").alias("k"), F.lit(0).alias("v")))
    return t


def _put(spark, t, version, *pairs):
    """Replace or insert the given (k, v) pairs; a None value deletes."""
    src = spark.createDataFrame([(k, v, version, "delete" if v is None else "update") for k, v in pairs], "k INT, v INT, seq INT, row_status STRING")

    def apply(cur, s):
        r = cdc_apply(cur.withColumn("seq", F.lit(0)), s, ["k"], "seq")
        r.state, r.changes = r.state.select("k", "v"), r.changes.drop("seq")
        return r
    t.commit(version, src, apply)


def test_restore_commits_without_writing_rows(spark):
    t = _counted(spark)
    _put(spark, t, 1, (1, 10), (2, None))
    _put(spark, t, 2, (1, 20), (100, 5))
    as_of_1 = rows(t.read(1))
    t.restore(1, version=3)
    assert rows(t.read()) == as_of_1 and rows(t.read(2)) != as_of_1
    assert list_names(spark, f"{t.path}/state/_tw_version=3") == []
    got = rows(t.changes(3, 3), "k", "v", "_change_type")
    assert got == [(1, 10, "update_postimage"), (1, 20, "update_preimage"), (100, 5, "delete")]
    t.restore(1, version=3)                                     # replayed
    assert rows(t.changes(3, 3), "k", "v", "_change_type") == got
    _put(spark, t, 4, (2, 7))                                   # and the table goes on from there
    assert (2, 7) in rows(t.read()) and (1, 10) in rows(t.read()) and len(rows(t.read())) == len(as_of_1) + 1
    with pytest.raises(ValueError):
        t.restore(9, version=5)


def test_reads_open_live_directories_only(spark):
    t = _counted(spark)
    for v in range(1, 6):
        _put(spark, t, v, (1, v))
    files = t.read().inputFiles()
    assert sum("_tw_version=0" in f for f in files) == len(files) - sum("_tw_version=5" in f for f in files)
    assert not any(f"_tw_version={v}" in f for f in files for v in (1, 2, 3, 4))
    one = t.read_buckets_of(spark.createDataFrame([(1,)], "k INT"))
    assert all("_tw_version=5" in f for f in one.inputFiles()) and (1, 5) in rows(one)
    empty = VersionedTable(spark, scratch_path(spark, "none"), ["k"])
    empty.create(spark.createDataFrame([], "k INT, v INT"))
    assert empty.read().collect() == [] and empty.latest_version() == 0


# ---- aggregates from change rows ----------------------------------------------------------------

VIEW = GoldView(keys={"g": "g", "parity": "v % 2"}, counts={"n": "1", "n_w": "w"}, sums={"total": "w"}, mins={"lo": "w"}, maxs={"hi": "w"},
                distincts={"kinds": "v"})


def test_maintained_view_equals_the_aggregate_after_every_commit(spark):
    rnd = random.Random(3)
    base = VersionedTable(spark, scratch_path(spark, "base"), ["k"], buckets=4)
    ddl = "k INT, g STRING, v INT, w INT, seq INT, row_status STRING"
    base.create(spark.createDataFrame([(i, rnd.choice(["a", "b", None]), rnd.randint(0, 4), rnd.choice([None, 1, 2, 3]), 0, "insert")
                                       for i in range(60)], ddl))
    gold = VersionedTable(spark, scratch_path(spark, "gold"), ["g", "parity"], buckets=8)
    gold.create(VIEW.full(base.read()))
    for version in range(1, 5):
        src = [(rnd.randint(0, 70), rnd.choice(["a", "b", "c", None]), rnd.randint(0, 4), rnd.choice([None, 1, 2, 9]), version,
                rnd.choice(["update", "delete", "update"])) for _ in range(12)]
        src = list({r[0]: r for r in src}.values()) if version < 4 else [(k, None, 0, None, version, "delete") for k in range(71)]
        base.commit(version, spark.createDataFrame(src, ddl), lambda cur, s: cdc_apply(cur, s, ["k"], "seq"))
        refresh(VIEW, gold, base, version, base.changes(version, version))
        refresh(VIEW, gold, base, version, base.changes(version, version))      # replayed
        full = VIEW.read(VIEW.full(base.read()))
        assert sorted(map(str, VIEW.read(gold.read()).collect())) == sorted(map(str, full.collect())), version
    assert gold.read().count() == 0 and not gold.changes(4, 4).filter("_change_type <> 'delete'").count()


def test_untouched_groups_are_not_read_or_written(spark):
    view = GoldView(keys={"g": "g"}, counts={"n": "1"}, sums={"s": "v"})
    base = VersionedTable(spark, scratch_path(spark, "base"), ["k"], buckets=4)
    base.create(spark.range(1000).select(F.col("id").cast("int").alias("k"), (F.col("id") % 50).cast("int").alias("g"), F.lit(1).alias("v")))
    gold = VersionedTable(spark, scratch_path(spark, "gold"), ["g"], buckets=16)
    gold.create(view.full(base.read()))
    base.commit(1, spark.createDataFrame([(5000, 7, 3)], "k INT, g INT, v INT"), lambda cur, s: merge_insert_only(cur, s, ["k"]))
    changes = base.changes(1, 1)
    # counts and sums need nothing but the deltas
    state = view.apply(gold.read(), view.deltas(changes), base.read()).state
    assert not any(base.path + "/state" in f for f in state.inputFiles())
    refresh(view, gold, base, 1, changes)
    assert len(list_names(spark, f"{gold.path}/state/_tw_version=1")) <= 2         # one bucket and _SUCCESS
    assert rows(view.read(gold.read()).filter("g IN (7, 8)")) == [(7, 21, 23), (8, 20, 20)]


# ---- bounded stream joins ---------------------------------------------------------------------

def test_join_state_is_bounded(spark):
    day = dt.datetime(2024, 1, 1)
    mk = lambda n, step: spark.createDataFrame([(i % 3, f"x{i % 2}", i, day + dt.timedelta(minutes=step * i)) for i in range(n)],
                                               f"a INT, b STRING, id{step} INT, t{step} TIMESTAMP")
    left, right = mk(2000, 10), mk(1000, 20)
    paths = [scratch_path(spark, "l"), scratch_path(spark, "r")]
    for lo in range(0, 20_000, 2000):
        for df, t, p in ((left, "t10", paths[0]), (right, "t20", paths[1])):
            at = (F.unix_seconds(t) - int(day.replace(tzinfo=dt.timezone.utc).timestamp())) / 60
            land_files(df.filter((at >= lo) & (at < lo + 2000)), "parquet", "t", files_per_chunk=1, path=p)
    ls, rs = (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(p) for df, p in ((left, paths[0]), (right, paths[1])))
    s = bounded_stream_join(ls, rs, ["a", "b"], ("t10", "t20"), ("5 minutes", "5 minutes"), "-30 minutes", "30 minutes", "left_outer")
    assert s.columns == ["a", "b", "id10", "t10", "id20", "t20"]
    out = scratch_path(spark, "out")
    q = s.writeStream.option("checkpointLocation", scratch_path(spark, "ck")).trigger(availableNow=True).format("parquet").start(out)
    q.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(kept) < 900 and kept[-1] < 60                    # 3,000 rows went in
    got = rows(spark.read.parquet(out), "id10", "id20")
    near = [(r["id10"], r["id20"]) for r in left.join(right, ["a", "b"]).filter(
        "abs(unix_seconds(t20) - unix_seconds(t10)) <= 1800").collect()]
    assert [g for g in got if g[1] is not None] == sorted(near)
    alone = {g[0] for g in got if g[1] is None}
    assert alone <= set(range(2000)) - {n[0] for n in near} and len(alone) > 300


def test_bounded_join_names(spark):
    a = spark.createDataFrame([], "k INT, t TIMESTAMP, x INT")
    with pytest.raises(ValueError):
        bounded_stream_join(a, a, ["k"], ("t", "t"), ("1 minute", "1 minute"))
    b = spark.createDataFrame([], "k INT, j INT, u TIMESTAMP")
    assert stream_stream_join(a.withColumn("j", F.lit(1)), b, ["k", "j"]).columns == ["k", "j", "t", "x", "u"]


# ---- partitions in their own type, states handed on ---------------------------------------------

def test_numeric_partitions_expire_by_value(spark):
    name = "expiring_numbers"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.createDataFrame([(1, 9, "x"), (2, 20, "x"), (3, 100, "y"), (4, None, "y")], "id INT, p INT, q STRING")
    df.write.partitionBy("p", "q").option("path", scratch_path(spark, name)).saveAsTable(name)
    archive = scratch_path(spark, "archive")
    assert expire_partitions(spark, name, "p", "20", archive) == ["9"]
    assert rows(spark.table(name), "id") == [(2,), (3,), (4,)] and rows(spark.read.parquet(archive), "id") == [(1,)]
    assert expire_partitions(spark, name, "p", "5") == []


def test_states_fed_back_keep_a_small_size_estimate(spark):
    from tidewell.operators.scd2 import scd2_apply
    from tidewell.plans.merge_queries import commit
    state, sizes = None, []
    for i in range(6):
        batch = spark.createDataFrame([(k, (k + i) % 5, dt.datetime(2024, 1, 1) + dt.timedelta(days=i), "n") for k in range(20)],
                                      "k INT, price INT, t TIMESTAMP, a STRING")
        state = commit(scd2_apply(state, batch, "k", "price", "t", ["a"]))
        sizes.append(input_bytes(state))
    assert max(sizes) < 1 << 20 and state.count() == 120
