"""Quality rules: CHECK constraints and pipeline expectations.

A rule set is ``{name: SQL predicate}``.  For CHECK constraints a rule whose
predicate is NULL passes, by SQL convention (``strict=True`` makes NULL fail);
expectations behave like filters, so there NULL fails.  Checks run in the
same job as the write: the violation raises inside the task that sees the row,
so a write fails as a whole and leaves no committed output.  Counts are one
aggregate, or ``observe`` metrics gathered while the data is written.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, str | Column]


def _ok(rule: str | Column, strict: bool = False) -> Column:
    p = F.expr(rule) if isinstance(rule, str) else rule
    return F.coalesce(p, F.lit(not strict))


def _all_ok(rules: Rules, strict: bool = False) -> Column:
    return reduce(lambda a, b: a & b, [_ok(r, strict) for r in rules.values()], F.lit(True))


def check_constraint(df: DataFrame, rules: Rules, strict: bool = False) -> DataFrame:
    """Rows pass through unchanged; the first violating row fails the job."""
    guard = F.lit(True)
    for name, rule in reversed(list(rules.items())):
        guard = F.when(_ok(rule, strict), guard).otherwise(
            F.raise_error(F.lit(f"CHECK constraint {name} violated")))
    return df.filter(guard)


def expect_fail(df: DataFrame, rules: Rules) -> DataFrame:
    """``ON VIOLATION FAIL UPDATE``: like ``check_constraint``, but a NULL result fails too."""
    return check_constraint(df, rules, strict=True)


def count_violations(df: DataFrame, rules: Rules, strict: bool = False) -> DataFrame:
    """One row: violating-row count per rule (a single aggregate pass)."""
    return df.agg(*[F.count_if(~_ok(r, strict)).alias(n) for n, r in rules.items()])


def validate_existing(df: DataFrame, rules: Rules, strict: bool = False) -> DataFrame:
    """Rows ``(constraint, violations)``: what adding the constraints would report."""
    counts = count_violations(df, rules, strict)
    pairs = ", ".join(f"'{n}', `{n}`" for n in rules)
    return counts.selectExpr(f"stack({len(rules)}, {pairs}) AS (constraint, violations)")


def ensure_valid(df: DataFrame, rules: Rules, strict: bool = False) -> None:
    """``ALTER TABLE … ADD CONSTRAINT``: raise listing violators if any row fails."""
    bad = {r["constraint"]: r["violations"] for r in validate_existing(df, rules, strict).collect()
           if r["violations"]}
    if bad:
        raise ValueError(f"constraints violated by existing rows: {bad}")


def expect_drop(df: DataFrame, rules: Rules, observation: Observation | None = None) -> DataFrame:
    """``ON VIOLATION DROP ROW``: keep rows whose rules are all true (a NULL result
    drops the row, as a filter does); dropped count in ``observation``."""
    ok = _all_ok(rules, strict=True)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("input_rows"),
                        F.count_if(~ok).alias("dropped_rows"))
    return df.filter(ok)


def expect_warn(df: DataFrame, rules: Rules, observation: Observation) -> DataFrame:
    """Keep every row; per-rule failure counts are reported through ``observation``."""
    return df.observe(observation, F.count(F.lit(1)).alias("input_rows"),
                      *[F.count_if(~_ok(r, strict=True)).alias(f"failed_{n}") for n, r in rules.items()])


def assert_unique(df: DataFrame, keys) -> DataFrame:
    """One row ``(n_rows, n_keys, is_unique)`` from one aggregate."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*[F.col(k) for k in keys]).alias("n_keys"))
    return out.withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))
