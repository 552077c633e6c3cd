"""Running Structured Streaming queries to completion and landing input files.

By default queries run with ``trigger(availableNow=True)``: every file present
at start is processed (in as many micro-batches as the source options allow),
then the query stops.  ``trigger="once"`` does the same in one micro-batch; a
processing-time interval (``"10 seconds"``) or ``trigger=None`` (Spark's default:
the next batch as soon as the last one ends) start a continuous query, which
runs until the data present has been processed (``processAllAvailable``) and
is then stopped; a long-running deployment would keep it running instead.
Checkpoints and outputs live under the shared checkpoint root.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from tidewell.session import scratch_path


def land_files(df: DataFrame, fmt: str, name: str, chunks: Sequence[Column] | None = None,
               files_per_chunk: int | None = None, path: str | None = None, **options) -> str:
    """Write ``df`` into a landing folder, optionally as time-ordered chunks.

    Each chunk is one write job, so files of later chunks have later
    modification times, which is the order a file stream source reads them in.
    ``files_per_chunk`` forces a file count and is meant only for tiny test inputs.
    """
    path = path or scratch_path(df.sparkSession, name)
    parts = [df] if not chunks else [df.filter(c) for c in chunks]
    for i, part in enumerate(parts):
        # the data's own partitioning decides the file count; a fixed count is for tiny tests
        out = part.repartition(files_per_chunk) if files_per_chunk else part
        w = out.write.mode("append").format(fmt)
        for k, v in options.items():
            w = w.option(k, v)
        w.save(path)
    return path


def run_available_now(sdf: DataFrame, name: str, *, path: str | None = None, fmt: str = "parquet",
                      output_mode: str = "append", partition_by: Sequence[str] | None = None,
                      foreach_batch: Callable[[DataFrame, int], None] | None = None,
                      checkpoint: str | None = None, trigger: str | None = "available_now", **options) -> str:
    """Run a streaming DataFrame to the end of the available input; return the output path.
    ``options`` are those of the file sink.

    ``trigger``: ``"available_now"`` (default), ``"once"``, a processing-time
    interval such as ``"5 seconds"``, or ``None`` for Spark's default trigger.
    """
    spark: SparkSession = sdf.sparkSession
    checkpoint = checkpoint or scratch_path(spark, f"checkpoint-{name}")
    w = sdf.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    finite = trigger in ("available_now", "once")
    if trigger == "available_now":
        w = w.trigger(availableNow=True)
    elif trigger == "once":
        w = w.trigger(once=True)
    elif trigger is not None:
        w = w.trigger(processingTime=trigger)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        path = path or scratch_path(spark, name)
        if partition_by:
            w = w.partitionBy(*partition_by)
        for k, v in options.items():
            w = w.option(k, v)
        q = w.format(fmt).start(path)
    if finite:
        q.awaitTermination()  # however long the input takes
    else:
        try:
            q.processAllAvailable()  # every file present has been committed to the sink
        finally:
            q.stop()
    if q.exception() is not None:
        raise q.exception()
    return path or checkpoint
