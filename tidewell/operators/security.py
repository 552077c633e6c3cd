"""Dynamic views: column masking and row filtering by group membership.

Membership is an argument (a boolean resolved by the caller's identity
service) so the same plan serves every role; the value is a literal in the plan
and Catalyst folds the CASE away.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK = "REDACTED"


def masked_view(df: DataFrame, pii_cols: Sequence[str], is_member: bool | Column) -> DataFrame:
    m = F.lit(is_member) if isinstance(is_member, bool) else is_member
    return df.select(*[F.when(m, F.col(c)).otherwise(F.lit(MASK)).alias(c) if c in pii_cols else F.col(c)
                       for c in df.columns])


def row_security(df: DataFrame, is_member: bool | Column, allowed: str | Column) -> DataFrame:
    """Members see every row; others only rows where ``allowed`` holds."""
    m = F.lit(is_member) if isinstance(is_member, bool) else is_member
    p = F.expr(allowed) if isinstance(allowed, str) else allowed
    return df.filter(F.when(m, F.lit(True)).otherwise(F.coalesce(p, F.lit(False))))
