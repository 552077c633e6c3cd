"""Expectation counts of running streams, kept as a table.

A stream that passes through ``observed`` carries its rules' counts along: Spark reports them with the progress of
each micro-batch, and ``ExpectationLog``, a streaming query listener, stores that report under
``<path>/_tw_query=<id>/_tw_batch=<n>``.  A batch that runs again after a failure replaces its own counts, so sums over
batches count every input row once.  The rows themselves take no further pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidewell.operators.quality import Rules, _all_ok, _ok

QUERY, BATCH = "_tw_query", "_tw_batch"
DDL = "name string, rule string, input_rows long, failed_rows long, dropped_rows long"
PREFIX = "expect:"
FAILED = "failed:"


def observed(df: DataFrame, name: str, rules: Rules, drop: bool = False) -> DataFrame:
    """``df`` with the counts of ``rules`` reported under ``name``; with ``drop`` only rows that fulfil all of them.

    A rule whose result is null fails, as an expectation does.  Several names may be used in one stream.
    """
    if not rules:
        raise ValueError("no rules")
    ok = _all_ok(rules, strict=True)
    dropped: Column = F.count_if(~ok) if drop else F.count_if(F.lit(False))
    df = df.observe(PREFIX + name, F.count(F.lit(1)).alias("input_rows"), dropped.alias("dropped_rows"),
                    *[F.count_if(~_ok(r, strict=True)).alias(FAILED + n) for n, r in rules.items()])
    return df.filter(ok) if drop else df


class ExpectationLog(StreamingQueryListener):
    """Attach with ``spark.streams.addListener(log)``; read with ``log.table()``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        out = []
        for key, metrics in p.observedMetrics.items():
            if not key.startswith(PREFIX) or metrics is None:
                continue
            m = metrics.asDict()
            out += [(key[len(PREFIX):], c[len(FAILED):], m["input_rows"], m[c], m["dropped_rows"]) for c in m if c.startswith(FAILED)]
        if out:
            (self.spark.createDataFrame(out, DDL).coalesce(1)
             .write.mode("overwrite").parquet(f"{self.path}/{QUERY}={p.id}/{BATCH}={p.batchId}"))

    def wait(self, timeout_ms: int = 60_000) -> None:
        """Until the reports of batches that have ended are stored: Spark delivers them a little later."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(timeout_ms)

    def table(self) -> DataFrame:
        """``name, rule, input_rows, failed_rows, dropped_rows`` and the query's id and batch number, one row a rule and batch."""
        return self.spark.read.schema(f"{DDL}, {QUERY} string, {BATCH} long").parquet(self.path)
