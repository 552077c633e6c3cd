"""Change-data-capture upserts built on ``merge_into`` and ``latest_per_key``."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.merge import Delete, Insert, MergeResult, Update, merge_into
from tidewell.operators.window import latest_per_key


def apply_changes(feed: DataFrame, keys: Sequence[str], sequence_by: str,
                  delete_when: str | Column | None = None, except_cols: Sequence[str] = ()) -> DataFrame:
    """``APPLY CHANGES INTO … KEYS … APPLY AS DELETE WHEN … SEQUENCE BY … COLUMNS * EXCEPT``.

    Batch form: per key the row with the highest sequence wins; if it is a
    delete the key is absent.  Arrival order does not matter.
    """
    last = latest_per_key(feed, keys, sequence_by)
    if delete_when is not None:
        dw = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
        last = last.filter(~F.coalesce(dw, F.lit(False)))
    return last.drop(*except_cols)


def scd1_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], sequence_by: str,
                status_col: str | None = "row_status", statuses: Sequence[str] = ("insert", "update"),
                method: str = "max_by") -> MergeResult:
    """Newest-wins upsert: latest accepted row per key; update only if newer, else insert.

    ``method="rank"`` keeps ties like the reference (and then MERGE raises on a
    duplicate); the default breaks ties deterministically.
    """
    src = source if status_col is None else source.filter(F.col(status_col).isin(*statuses))
    src = latest_per_key(src, keys, sequence_by, method=method)
    # max_by leaves one row per key, so only the tie-keeping rank form needs the duplicate check
    return merge_into(target, src, list(keys),
                      matched=[Update(F.col(f"t.{sequence_by}") < F.col(f"s.{sequence_by}"))],
                      not_matched=[Insert()], check_cardinality=(method != "max_by"))


def cdc_apply(target: DataFrame, source: DataFrame, keys: Sequence[str], sequence_by: str,
              status_col: str = "row_status", delete_value: str = "delete",
              guard_deletes: bool = True) -> MergeResult:
    """CDC with deletes: a matched delete removes the row, a newer row replaces it,
    an unmatched non-delete row is inserted.

    A delete older than the row is ignored, as an older update is; ``guard_deletes=False``
    lets every delete act.  A deleted row leaves no trace, so a late insert brings it
    back: use the tombstoned form (``streaming.cdc``) where that must not happen."""
    src = latest_per_key(source, keys, sequence_by)
    is_del = F.col(f"s.{status_col}") == delete_value
    return merge_into(target, src, list(keys),
                      matched=[Delete(is_del & (F.col(f"t.{sequence_by}") <= F.col(f"s.{sequence_by}"))
                                      if guard_deletes else is_del),
                               Update(~is_del & (F.col(f"t.{sequence_by}") < F.col(f"s.{sequence_by}")))],
                      not_matched=[Insert(~is_del)], check_cardinality=False)  # unique by construction
