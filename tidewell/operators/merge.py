"""MERGE and its special cases as pure DataFrame functions.

``merge_into`` returns the new table state and the change rows of the same
commit.  The plan is three joins on the merge keys that share one shuffle of
each side (Spark reuses the exchange):

* ``target ▷ source`` (left anti, on the keys and on "some clause fires") – target rows
  that nothing modifies, each once, however many source rows they match;
* ``target ⋈ source`` (inner, same condition) – the pairs that update or delete;
* ``source ▷ target`` (left anti, on the keys) – candidates for the WHEN NOT MATCHED clauses.

Inner and anti joins let adaptive execution split a skewed key's partition,
which a full outer join would not.  Conditions are SQL strings or Columns that
name the sides ``t`` (target) and ``s`` (source).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHANGE_TYPE = "_change_type"


@dataclass(frozen=True)
class Update:
    """``WHEN MATCHED [AND condition] THEN UPDATE SET …`` (``set=None`` means ``SET *``)."""
    condition: str | Column | None = None
    set: Mapping[str, str | Column] | None = None


@dataclass(frozen=True)
class Delete:
    """``WHEN MATCHED [AND condition] THEN DELETE``."""
    condition: str | Column | None = None


@dataclass(frozen=True)
class Insert:
    """``WHEN NOT MATCHED [AND condition] THEN INSERT …`` (``values=None`` means ``INSERT *``)."""
    condition: str | Column | None = None
    values: Mapping[str, str | Column] | None = None


@dataclass
class MergeResult:
    state: DataFrame
    changes: DataFrame


def _col(e: str | Column) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def _cond(e: str | Column | None) -> Column:
    return F.lit(True) if e is None else F.coalesce(_col(e), F.lit(False))


def _on(on: Sequence[str] | Mapping[str, str], extra: str | Column | None) -> Column:
    pairs = on.items() if isinstance(on, Mapping) else [(k, k) for k in on]
    cond = reduce(lambda a, b: a & b, [F.col(f"t.{tk}") == F.col(f"s.{sk}") for tk, sk in pairs])
    return cond if extra is None else cond & _col(extra)


def merge_into(target: DataFrame, source: DataFrame, on: Sequence[str] | Mapping[str, str],
               matched: Sequence[Update | Delete] = (), not_matched: Sequence[Insert] = (),
               extra_condition: str | Column | None = None,
               check_cardinality: bool = True) -> MergeResult:
    """General MERGE.  ``on`` lists key columns (same name both sides) or maps target→source.

    Semantics follow SQL MERGE: clauses are tried in order and the first whose
    condition is true wins; a matched row no clause accepts is kept; a source
    row no NOT MATCHED clause accepts is dropped; ``SET *``/``INSERT *`` take
    target columns from the source by name (extra source columns are ignored).
    A target row that more than one source row would modify raises an error; source
    rows that match it without a clause firing do not count.
    """
    tcols = target.columns
    ttypes = {f.name: f.dataType for f in target.schema.fields}
    skeys = list(on.values()) if isinstance(on, Mapping) else list(on)
    tkeys = list(on)

    check = check_cardinality and bool(matched)
    src = source
    if check:
        # keys with several source rows: a partial aggregate (hot keys combine map-side),
        # joined back; usually tiny, so adaptive execution broadcasts it
        dups = (source.groupBy(*skeys).agg(F.count(F.lit(1)).alias("_s_n"))
                .filter(F.col("_s_n") > 1)
                .select(*[F.col(k).alias(f"_dk{i}") for i, k in enumerate(skeys)], "_s_n"))
        src = (src.join(dups, [F.col(k) == F.col(f"_dk{i}") for i, k in enumerate(skeys)], "left")
               .select(*source.columns, F.col("_s_n").isNotNull().alias("_s_dup"),
                       F.monotonically_increasing_id().alias("_s_id")))
    t = target.alias("t")
    s = src.alias("s")
    cond = _on(on, extra_condition)

    # ---- matched pairs -------------------------------------------------------
    action = F.lit("keep")
    for i, clause in reversed(list(enumerate(matched))):
        tag = f"u{i}" if isinstance(clause, Update) else "del"
        action = F.when(_cond(clause.condition), F.lit(tag)).otherwise(action)
    fires = reduce(lambda a, b: a | b, [_cond(c.condition) for c in matched], F.lit(False))

    def updated_value(c: str) -> Column:
        v = F.col(f"t.{c}")
        for i, clause in reversed(list(enumerate(matched))):
            if not isinstance(clause, Update):
                continue
            if clause.set is None:
                new = F.col(f"s.{c}")
            elif c in clause.set:
                new = _col(clause.set[c])
            else:
                continue
            v = F.when(F.col("_action") == f"u{i}", new.cast(ttypes[c])).otherwise(v)
        return v.alias(c)

    if matched:
        kept = t.join(s, cond & fires, "left_anti").select(*[F.col(f"t.{c}").alias(c) for c in tcols])
        pairs = t.join(s, cond & fires, "inner").withColumn("_action", action)
        pre = F.struct(*[F.col(f"t.{c}").alias(c) for c in tcols])
        post = F.struct(*[updated_value(c) for c in tcols])
        extra = [F.col("s._s_dup"), F.col("s._s_id")] if check else []
        pairs = pairs.select(F.col("_action"), pre.alias("_pre"), post.alias("_post"), *extra)
        if check:
            pairs = _one_modifier(pairs, tkeys).select("_action", "_pre", "_post")
    else:
        kept, pairs = target, None

    # ---- not matched: inserts ---------------------------------------------------
    parts = [kept]
    if pairs is not None:
        parts.append(pairs.filter(F.col("_action") != "del").select("_post.*"))
    inserted = None
    if not_matched:
        cand = s.join(t, cond, "left_anti")
        choice = F.lit(None).cast("int")
        for i, clause in reversed(list(enumerate(not_matched))):
            choice = F.when(_cond(clause.condition), F.lit(i)).otherwise(choice)
        cand = cand.withColumn("_ins", choice).filter(F.col("_ins").isNotNull())

        def inserted_value(c: str) -> Column:
            v = F.lit(None).cast(ttypes[c])
            for i, clause in reversed(list(enumerate(not_matched))):
                if clause.values is None:
                    new = F.col(f"s.{c}")
                elif c in clause.values:
                    new = _col(clause.values[c])
                else:
                    new = F.lit(None)
                v = F.when(F.col("_ins") == i, new.cast(ttypes[c])).otherwise(v)
            return v.alias(c)

        inserted = cand.select(*[inserted_value(c) for c in tcols])
        parts.append(inserted)

    state = reduce(DataFrame.unionByName, parts)

    # ---- change rows of this commit ----------------------------------------------
    typed = lambda st, kind: F.struct(*[F.col(f"{st}.{c}") for c in tcols],
                                      F.lit(kind).alias(CHANGE_TYPE))
    change_parts = []
    if pairs is not None:
        change_parts += [
            pairs.filter(F.col("_action").startswith("u")).select(F.explode(F.array(
                typed("_pre", "update_preimage"), typed("_post", "update_postimage"))).alias("r")).select("r.*"),
            pairs.filter(F.col("_action") == "del").select(typed("_pre", "delete").alias("r")).select("r.*")]
    if inserted is not None:
        change_parts.append(inserted.withColumn(CHANGE_TYPE, F.lit("insert")))
    if not change_parts:
        change_parts = [target.limit(0).withColumn(CHANGE_TYPE, F.lit("insert"))]
    changes = reduce(DataFrame.unionByName, change_parts)
    return MergeResult(state, changes)


def _one_modifier(pairs: DataFrame, tkeys: Sequence[str]) -> DataFrame:
    """Raise where a target row is modified by several source rows.

    Only pairs whose source key occurs more than once are looked at: among the pairs of
    one target row (its keys and a hash of all its columns) there must be one source row.
    """
    row = Window.partitionBy(*[F.col(f"_pre.{k}") for k in tkeys], F.xxhash64("_pre"))
    several = F.min("_s_id").over(row) != F.max("_s_id").over(row)
    failed = F.raise_error(F.lit("MERGE: a target row matched more than one source row"))
    judged = (pairs.filter("_s_dup").withColumn("_several", several)
              .withColumn("_action", F.when(F.col("_several"), failed).otherwise(F.col("_action"))))
    return pairs.filter("NOT _s_dup").unionByName(judged.drop("_several"))


# ---- special cases ---------------------------------------------------------------


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str],
                      condition: str | Column | None = None) -> MergeResult:
    """``WHEN NOT MATCHED [AND p] THEN INSERT *``: idempotent on re-run; does not
    deduplicate the source itself (two equal new rows are both inserted)."""
    src = source if condition is None else source.filter(_cond(condition))
    new = src.join(target.select(*keys), list(keys), "left_anti").select(*target.columns)
    return MergeResult(target.unionByName(new), new.withColumn(CHANGE_TYPE, F.lit("insert")))


def update_where(target: DataFrame, predicate: str | Column,
                 assignments: Mapping[str, str | Column]) -> MergeResult:
    """``UPDATE t SET … WHERE p``; rows where ``p`` is NULL are left alone."""
    hit = _cond(predicate)
    types = {f.name: f.dataType for f in target.schema.fields}
    cols = [F.when(F.col("_hit"), _col(assignments[c]).cast(types[c])).otherwise(F.col(c)).alias(c)
            if c in assignments else F.col(c) for c in target.columns]
    tagged = target.withColumn("_hit", hit)
    state = tagged.select(*cols)
    pre = F.struct(*[F.col(c) for c in target.columns], F.lit("update_preimage").alias(CHANGE_TYPE))
    post = F.struct(*cols, F.lit("update_postimage").alias(CHANGE_TYPE))
    changes = (tagged.filter("_hit").select(F.explode(F.array(pre, post)).alias("r")).select("r.*"))
    return MergeResult(state, changes)


def delete_where(target: DataFrame, predicate: str | Column | None = None) -> MergeResult:
    """``DELETE FROM t [WHERE p]``; a NULL predicate keeps the row."""
    hit = _cond(predicate)
    return MergeResult(target.filter(~hit),
                       target.filter(hit).withColumn(CHANGE_TYPE, F.lit("delete")))


def delete_in(target: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> MergeResult:
    """``DELETE FROM t WHERE k IN (subquery)``: anti join for the state, semi join for the changes."""
    keyset = keys_df.select(*on)
    return MergeResult(target.join(keyset, list(on), "left_anti"),
                       target.join(keyset, list(on), "left_semi").withColumn(CHANGE_TYPE, F.lit("delete")))
