"""Delete requests and their propagation (right-to-be-forgotten flow).

``delete_requests`` turns CDC delete rows into requests with a deadline;
``propagate_deletes`` removes the keys from a downstream table and marks the
requests done.  Both are pure functions, so a ``foreachBatch`` writer can call
them per micro-batch and the batch job can call them once.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.merge import MergeResult, Update, delete_in, merge_into

DEADLINE_DAYS = 30


def delete_requests(feed: DataFrame, key: str = "customer_id", ts: str = "row_time",
                    status_col: str = "row_status", delete_value: str = "delete") -> DataFrame:
    return (feed.filter(F.col(status_col) == delete_value)
            .select(key, F.col(ts).alias("request_timestamp"),
                    F.date_add(F.col(ts), DEADLINE_DAYS).alias("deadline"),
                    F.lit("requested").alias("status")))


def delete_downstream(deleted_keys: DataFrame, downstream: DataFrame, keys: Sequence[str]) -> MergeResult:
    """Remove every downstream row of a deleted key (anti join; change rows by semi join)."""
    return delete_in(downstream, deleted_keys.select(*keys).distinct(), keys)


def mark_deleted(deleted_keys: DataFrame, requests: DataFrame, keys: Sequence[str]) -> MergeResult:
    """``MERGE … WHEN MATCHED THEN UPDATE SET status = 'deleted'``."""
    return merge_into(requests, deleted_keys.select(*keys).distinct(), list(keys),
                      matched=[Update(None, {"status": "'deleted'"})], check_cardinality=False)


def propagate_deletes(deleted_keys: DataFrame, downstream: DataFrame, requests: DataFrame,
                      keys: Sequence[str]) -> tuple[MergeResult, MergeResult]:
    """Both effects of one batch of deletes: downstream rows removed, requests marked."""
    return delete_downstream(deleted_keys, downstream, keys), mark_deleted(deleted_keys, requests, keys)
