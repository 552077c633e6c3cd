"""Aggregate tables kept up to date from change rows.

A commit's change rows become signed deltas per group: an insert or postimage counts plus, a
delete or preimage minus.  Counts and sums add their deltas.  A minimum or maximum takes
in new values directly, and is computed anew only in groups that lost a value at or beyond
it; distinct counts are computed anew in the groups the commit touched.  Groups without a
delta are not read, a group without rows left goes.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.changes import CT, CV
from tidewell.operators.merge import MergeResult

ROWS = "_rows"      # rows of a group


@dataclass(frozen=True)
class GoldView:
    """``SELECT keys, aggregates FROM base GROUP BY keys``; all values are SQL expressions over the base.

    Null group keys are groups like any other.  A sum over no non-null value is null, as in SQL
    (sums carry a count of them).  Sums of integers and decimals are exact; sums of doubles
    may differ from a full aggregate in the last digits.
    """
    keys: Mapping[str, str]
    counts: Mapping[str, str] = field(default_factory=dict)      # non-null values; "1" counts rows
    sums: Mapping[str, str] = field(default_factory=dict)
    mins: Mapping[str, str] = field(default_factory=dict)
    maxs: Mapping[str, str] = field(default_factory=dict)
    distincts: Mapping[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.counts, *self.sums, *self.mins, *self.maxs, *self.distincts]

    @property
    def stored(self) -> list[str]:
        return [*self.columns, ROWS, *[f"_n_{c}" for c in self.sums]]

    def _group(self, rows: DataFrame):
        return rows.groupBy(*[F.expr(e).alias(k) for k, e in self.keys.items()])

    def _same(self, a: str, b: str) -> Column:
        return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in self.keys])

    def _recomputed(self) -> list[Column]:
        return [*[F.min(F.expr(e)).alias(c) for c, e in self.mins.items()],
                *[F.max(F.expr(e)).alias(c) for c, e in self.maxs.items()],
                *[F.countDistinct(F.expr(e)).alias(c) for c, e in self.distincts.items()]]

    def full(self, base: DataFrame) -> DataFrame:
        """The aggregate of the whole base, with the columns that maintenance needs."""
        out = self._group(base).agg(
            *[F.count(F.expr(e)).alias(c) for c, e in self.counts.items()], *[F.sum(F.expr(e)).alias(c) for c, e in self.sums.items()],
            *self._recomputed(), F.count(F.lit(1)).alias(ROWS), *[F.count(F.expr(e)).alias(f"_n_{c}") for c, e in self.sums.items()])
        return out.select(*self.stored)

    def deltas(self, changes: DataFrame) -> DataFrame:
        """One row per group that the change rows touch."""
        plus = F.col(CT).isin("insert", "update_postimage")
        sign = F.when(plus, 1).otherwise(-1)
        signed = lambda e: F.sum(F.when(F.expr(e).isNotNull(), sign).otherwise(0))
        aggs = [F.sum(sign).alias(ROWS), *[signed(e).alias(c) for c, e in self.counts.items()]]
        for c, e in self.sums.items():
            aggs += [F.sum(F.expr(e) * sign).alias(c), signed(e).alias(f"_n_{c}")]
        for f, named in ((F.min, self.mins), (F.max, self.maxs)):
            for c, e in named.items():
                aggs += [f(F.when(plus, F.expr(e))).alias(f"_in_{c}"), f(F.when(~plus, F.expr(e))).alias(f"_out_{c}")]
        return self._group(changes).agg(*aggs)

    def apply(self, current: DataFrame, deltas: DataFrame, base: DataFrame) -> MergeResult:
        """``current`` (stored columns) with the deltas taken in, and the change rows of the view itself.

        ``base`` is the base table after the commit; it is read only for groups whose minimum,
        maximum or distinct count cannot be told from the deltas.
        """
        j = current.alias("g").join(deltas.alias("d"), self._same("g", "d"), "full_outer")
        key = {k: F.when(F.col(f"d.{ROWS}").isNull(), F.col(f"g.{k}")).otherwise(F.col(f"d.{k}")) for k in self.keys}
        add = lambda c: F.coalesce(F.col(f"g.{c}"), F.lit(0)) + F.coalesce(F.col(f"d.{c}"), F.lit(0))
        new = {**key, ROWS: add(ROWS), **{c: add(c) for c in self.counts}}
        for c in self.sums:
            new[f"_n_{c}"] = add(f"_n_{c}")
            new[c] = F.when(add(f"_n_{c}") > 0, add(c))
        touched = F.col(f"d.{ROWS}").isNotNull()
        again = F.lit(False)
        for c in self.mins:
            again = again | F.coalesce(F.col(f"d._out_{c}") <= F.col(f"g.{c}"), F.lit(False))
            new[c] = F.least(F.col(f"g.{c}"), F.col(f"d._in_{c}"))
        for c in self.maxs:
            again = again | F.coalesce(F.col(f"d._out_{c}") >= F.col(f"g.{c}"), F.lit(False))
            new[c] = F.greatest(F.col(f"g.{c}"), F.col(f"d._in_{c}"))
        if self.distincts:
            again = again | touched
            new.update({c: F.col(f"g.{c}") for c in self.distincts})
        types = {f.name: f.dataType for f in current.schema.fields}
        before = F.when(F.col(f"g.{ROWS}").isNotNull(), F.struct(*[F.col(f"g.{c}").alias(c) for c in self.stored]))
        j = j.select(*[new[c].cast(types[c]).alias(c) for c in self.stored], before.alias("_before"), touched.alias("_touched"),
                     (touched & again & (add(ROWS) > 0)).alias("_again"))
        if self.mins or self.maxs or self.distincts:
            j = self._recompute(j, base)
        state = j.filter(F.col(ROWS) > 0).select(*self.stored)
        after = F.struct(*[F.col(c) for c in self.stored])
        kind = lambda row, name: F.struct(*[row[c].alias(c) for c in self.stored], F.lit(name).alias(CT))
        old = F.col("_before")
        events = (F.when((F.col(ROWS) > 0) & old.isNull(), F.array(kind(F.col("_after"), "insert")))
                  .when((F.col(ROWS) <= 0) & old.isNotNull(), F.array(kind(old, "delete")))
                  .when((F.col(ROWS) > 0) & ~old.eqNullSafe(F.col("_after")),
                        F.array(kind(old, "update_preimage"), kind(F.col("_after"), "update_postimage"))))
        changes = (j.filter("_touched").withColumn("_after", after).select(F.explode(events).alias("r")).select("r.*"))
        return MergeResult(state, changes)

    def _recompute(self, j: DataFrame, base: DataFrame) -> DataFrame:
        wanted = j.filter("_again").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)])
        match = reduce(lambda a, b: a & b, [F.expr(e).eqNullSafe(F.col(f"_k{i}")) for i, e in enumerate(self.keys.values())])
        fresh = self._group(base.join(wanted, match, "left_semi")).agg(*self._recomputed())
        named = [*self.mins, *self.maxs, *self.distincts]
        out = j.alias("j").join(fresh.alias("f"), self._same("j", "f") & F.col("j._again"), "left")
        return out.select(*[(F.when(F.col("j._again"), F.col(f"f.{c}")).otherwise(F.col(f"j.{c}")) if c in named
                             else F.col(f"j.{c}")).alias(c) for c in j.columns])

    def read(self, stored: DataFrame) -> DataFrame:
        """The view's own columns."""
        return stored.select(*self.columns)


def refresh(view: GoldView, gold, base, version: int, changes: DataFrame) -> None:
    """Take ``changes`` of ``base`` into ``gold`` (both ``VersionedTable``) as ``version``, once.

    Only the gold buckets that hold touched groups are read and written.  The base is read
    as of the newest version among the changes, so a replay sees what the first try saw.
    """
    at = changes.agg(F.max(CV)).first()[0]
    if at is not None:
        gold.commit(version, view.deltas(changes), lambda cur, d: view.apply(cur, d, base.read(at)),
                    commit_ts=F.lit(None).cast("timestamp"))
