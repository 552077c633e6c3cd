"""Streaming ``APPLY CHANGES``: newest sequence wins, deletes kept as tombstones.

State rows carry ``_deleted`` and the sequence value of the last change, so a
change that arrives late with an older sequence can neither revive a deleted
key nor overwrite a newer row.  Readers drop tombstones.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.merge import Insert, MergeResult, Update, merge_into
from tidewell.operators.window import latest_per_key

DELETED = "_deleted"


def apply_changes_batch(state: DataFrame, batch: DataFrame, keys: Sequence[str], sequence_by: str,
                        delete_when: Column, except_cols: Sequence[str] = ()) -> MergeResult:
    """One micro-batch into a tombstoned state table (state columns = kept columns + ``_deleted``)."""
    src = latest_per_key(batch.withColumn(DELETED, F.coalesce(delete_when, F.lit(False))),
                         keys, sequence_by)
    keep = [c for c in state.columns]
    src = src.select(*[c for c in keep])
    return merge_into(state, src, list(keys),
                      matched=[Update(F.col(f"t.{sequence_by}") < F.col(f"s.{sequence_by}"))],
                      not_matched=[Insert()])


def live_rows(state: DataFrame, except_cols: Sequence[str] = ()) -> DataFrame:
    return state.filter(~F.col(DELETED)).drop(DELETED, *except_cols)
