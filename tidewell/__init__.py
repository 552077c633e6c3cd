"""tidewell: incremental lakehouse analytics expressed as Spark DataFrame plans.

Every operator is a plain function from DataFrames to DataFrames.  Row-change
operators (MERGE, type-1/type-2 upserts, change feeds) return new state and
change rows computed by the same joins, so they can run in batch jobs or inside
``foreachBatch`` of a Structured Streaming query.
"""

__version__ = "0.1.0"
