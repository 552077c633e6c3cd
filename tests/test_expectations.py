import pytest
from pyspark.sql import functions as F

from tidewell.session import scratch_path
from tidewell.streaming.expectations import ExpectationLog, observed
from tidewell.streaming.runner import land_files, run_available_now
from conftest import rows

DDL = "id INT, v INT"


def test_counts_of_each_micro_batch(spark):
    landing, out, ckpt = (scratch_path(spark, n) for n in ("landing-x", "out-x", "ckpt-x"))
    log = ExpectationLog(spark, scratch_path(spark, "log-x"))
    rules = {"positive": "v > 0", "small one": "v < 5"}
    spark.streams.addListener(log)
    try:
        for batch in ([(1, 1), (2, -1), (3, None)], [(4, 9), (5, 2)]):      # null fails both rules
            land_files(spark.createDataFrame(batch, DDL), "parquet", "landing", files_per_chunk=1, path=landing)
            feed = observed(spark.readStream.schema(DDL).parquet(landing), "r", rules, drop=True)
            run_available_now(feed, "x", path=out, checkpoint=ckpt)
        log.wait()
    finally:
        spark.streams.removeListener(log)
    assert rows(log.table(), "_tw_batch", "name", "rule", "input_rows", "failed_rows", "dropped_rows") == [
        (0, "r", "positive", 3, 2, 2), (0, "r", "small one", 3, 1, 2), (1, "r", "positive", 2, 0, 1), (1, "r", "small one", 2, 1, 1)]
    assert rows(spark.read.schema(DDL).parquet(out)) == [(1, 1), (5, 2)]


def test_warning_rules_keep_every_row(spark):
    df = spark.createDataFrame([(1, 1), (2, None)], DDL)
    assert rows(observed(df, "w", {"positive": F.col("v") > 0}), "id") == [(1,), (2,)]
    with pytest.raises(ValueError):
        observed(df, "w", {})
