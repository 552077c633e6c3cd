import glob
import os

import pytest
from pyspark.sql import functions as F

from tidewell.operators import layout as L
from tidewell.session import remove_path, scratch_path

TARGET = 40_000


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def _write(spark, path, n, files, seed=0, mode="append"):
    df = spark.range(n).select(F.col("id"), F.sha2(F.concat(F.col("id"), F.lit(seed)), 256).alias("s"),
                               F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, F.lit("b/c :é")).otherwise(F.lit("a")).alias("p"))
    df.repartition(files).write.mode(mode).partitionBy("p").parquet(path)


def _rows(spark, path):
    return sorted((r["id"], r["s"], r["p"] or "") for r in spark.read.parquet(path).collect())


def test_small_files_are_packed_once(spark):
    path = scratch_path(spark, "small")
    _write(spark, path, 6000, 30)
    _write(spark, path, 20000, 1, seed=1)           # files that are large enough
    before, rows = _files(path), _rows(spark, path)
    large = {f: t for f, t in before.items() if 2 * os.path.getsize(f) >= TARGET}
    went, came = L.pack_small_files(spark, path, TARGET)
    after = _files(path)
    assert _rows(spark, path) == rows
    assert large and all(after.get(f) == t for f, t in large.items())
    assert went == len(before) - len(before.keys() & after.keys()) and came == len(after.keys() - before.keys())
    assert 0 < 4 * came < went and not os.path.exists(f"{path}/{L.PACKING}")
    # a small file a folder may be left; a second run leaves every file alone
    assert L.pack_small_files(spark, path, TARGET) == (0, 0) and _files(path) == after
    # new small files are packed with what was left
    _write(spark, path, 600, 5, seed=2)
    rows = _rows(spark, path)
    assert L.pack_small_files(spark, path, TARGET)[0] >= 10 and _rows(spark, path) == rows


@pytest.mark.parametrize("cut", ["before the marker", "after a move"])
def test_a_run_cut_off_is_finished(spark, monkeypatch, cut):
    path = scratch_path(spark, "small-cut")
    _write(spark, path, 3000, 12)
    rows = _rows(spark, path)
    if cut == "after a move":
        calls = []

        def remove(s, p):
            calls.append(p)
            if len(calls) == 5:
                raise OSError("lost")
            remove_path(s, p)
        monkeypatch.setattr(L, "remove_path", remove)
    else:
        def finish(s, p):
            if os.path.exists(f"{p}/{L.PACKING}"):
                remove_path(s, f"{p}/{L.PACKING}/done")
                raise OSError("lost")
            return 0, 0
        monkeypatch.setattr(L, "_finish_packing", finish)
    with pytest.raises(OSError, match="lost"):
        L.pack_small_files(spark, path, TARGET)
    if cut == "before the marker":
        assert _rows(spark, path) == rows
    monkeypatch.undo()
    L.pack_small_files(spark, path, TARGET)
    assert _rows(spark, path) == rows
    assert L.pack_small_files(spark, path, TARGET) == (0, 0)


def test_odd_folders(spark):
    assert L.pack_small_files(spark, scratch_path(spark, "nothing-here")) == (0, 0)
    # files without rows, files of an older schema, equal data given twice
    path = scratch_path(spark, "small-odd")
    spark.range(0).repartition(1).write.mode("append").parquet(path)
    for _ in range(2):
        spark.range(100).repartition(1).write.mode("append").parquet(path)
        spark.range(100).withColumn("x y.z", F.lit("é")).repartition(1).write.mode("append").parquet(path)
    read = lambda: sorted(map(str, spark.read.option("mergeSchema", "true").parquet(path).collect()))
    rows = read()
    assert L.pack_small_files(spark, path)[1] == 1 and read() == rows and len(rows) == 400 and len(_files(path)) == 1
    # the same bytes again must not meet the packed file's name
    for _ in range(2):
        spark.range(100).repartition(1).write.mode("append").parquet(path)
    rows = read()
    L.pack_small_files(spark, path)
    assert read() == rows and len(rows) == 600


def test_other_files_are_not_scanned(spark):
    path = scratch_path(spark, "small-pruned")
    _write(spark, path, 20000, 1)
    _write(spark, path, 300, 4, seed=1)
    size = L._weight(F.col("_metadata.file_size"), F.col("_metadata.file_name"))
    read = spark.read.option("recursiveFileLookup", "true").parquet(path)
    # Spark drops files by the condition when it lists them
    plan = read.filter(size * 2 < TARGET)._jdf.queryExecution().executedPlan()
    small = sum(2 * os.path.getsize(f) < TARGET for f in _files(path))
    scans = plan.collectLeaves()
    assert scans.apply(0).selectedPartitions().totalNumberOfFiles() == small < len(_files(path))


def test_a_task_writes_one_group_without_sorting_it(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    path, key, held = scratch_path(spark, "small-tasks"), "spark.sql.maxConcurrentOutputFileWriters", {}
    _write(spark, path, 20000, 60)
    rows, parquet, finish, was = _rows(spark, path), DataFrameWriter.parquet, L._finish_packing, spark.conf.get(key, "0")

    def write(self, p, *a, **k):
        held[p.rsplit("/", 1)[-1]] = spark.conf.get(key, "0")
        return parquet(self, p, *a, **k)
    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    monkeypatch.setattr(L, "_finish_packing", lambda s, p: (0, 0))     # the new files stay where they were written
    L.pack_small_files(spark, path, TARGET)
    parts = glob.glob(f"{path}/{L.PACKING}/rows/*/part-*")
    tasks = sorted(int(os.path.basename(p).split("-")[1]) for p in parts)
    assert len(tasks) > 8 and tasks == list(range(len(tasks)))
    assert held["rows"] != "0" and held["plan"] == was == spark.conf.get(key, "0")
    monkeypatch.setattr(L, "_finish_packing", finish)
    L.pack_small_files(spark, path, TARGET)
    assert _rows(spark, path) == rows
