"""Mixing sources to target weights by a min-cost flow over membership patterns.

Documents that belong to the same set of sources form a pattern.  Only the patterns' token
counts enter the flow network: each copy of a pattern's tokens is an arc whose cost grows
with the number of the copy (convex, so a first copy anywhere comes before a second one),
patterns lead to their sources, and each source takes tokens up to its quota.  Patterns
and sources that are linked form a component; components are solved apart, in tasks.  The
flow says how many tokens each pattern gives; documents are then taken in a seeded order.

Sources and patterns are tables like any other: ranks, targets and prefix sums are computed by
Spark, and a hot source is a hot key of partial aggregates and of adaptive joins only.
"""

from __future__ import annotations

import heapq
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewell.llm.components import connected_components
from tidewell.llm.positions import positions
from tidewell.llm.textops import Batch, slices
from tidewell.session import scratch_path

MAX_ARCS = 200_000      # arcs of one component of patterns and sources; a larger one is an error
REFILLS = 3             # passes that fill what a document too long for the rest of a quota leaves


def word_counts(docs: DataFrame, *keep: Column, text_col: str = "text") -> DataFrame:
    """``keep`` and ``size``, the number of words ``[^\\x20\\x09-\\x0D]+`` of each whole text (null: 0)."""
    src = docs.select(*keep, F.col(text_col).alias("_mix_text"))
    kept = [f for f in src.schema.fields if f.name != "_mix_text"]

    def count(batches):
        for piece in slices(batches, "_mix_text"):
            size = Batch(piece.column("_mix_text")).n_words.astype(np.int64)
            yield pa.RecordBatch.from_arrays([*(piece.column(f.name) for f in kept), pa.array(size)],
                                             [*(f.name for f in kept), "size"])

    return src.mapInArrow(count, T.StructType([*kept, T.StructField("size", T.LongType())]))


def source_key(source: Column) -> Column:
    """A key that is never null and sorts by code point, the null source last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def source_targets(sizes: DataFrame, total: int, weights: Sequence[int] = (5, 2, 1), share: float = 1.5,
                   max_repeats: int = 2) -> DataFrame:
    """(source, source_size) with ``target``: sources in key order weigh ``weights`` in turn and share
    ``share * total``; no target is above ``max_repeats`` times its source, what is too much
    goes to the others by weight until none is above.

    Each round is one aggregate over the table of sources; at least one more source is at
    its limit after it, so the rounds end.
    """
    ranked = positions(_stored(sizes.withColumn("_all", F.lit(0)), "mix-sources"), ["_all"], ["source"]).drop("_all")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    s = _stored(ranked.select("source", "source_size", weight.cast("double").alias("w"),
                              (F.lit(max_repeats) * F.col("source_size")).cast("double").alias("cap")), "mix-weights")
    full, left, w_left, n = F.lit(False), share * total, 0.0, -1
    while True:
        r = s.agg(F.sum(F.when(full, F.col("cap"))).alias("cap"), F.sum(F.when(~full, F.col("w"))).alias("w"),
                  F.count(F.when(full, 1)).alias("n")).first()
        if r["n"] == n or not r["w"]:
            break
        n, left, w_left = r["n"], share * total - (r["cap"] or 0.0), r["w"]
        # the share of a unit of weight only grows, so this holds for the sources of earlier rounds too
        full = F.col("cap") * F.lit(w_left) <= F.col("w") * F.lit(left)
    target = F.when(full, F.col("cap")).otherwise(F.col("w") * F.lit(left) / F.lit(w_left or 1.0))
    return s.select("source", "source_size", target.alias("target"))


def min_cost_flow(tokens: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int],
                  copies: int) -> list[list[int]]:
    """Tokens that each pattern gives to each of its sources (in the order of ``members``).

    Successive shortest paths with potentials: from the start through a pattern's copies (copy k
    costs k a token) and its sources to the end.  Every source gets as much of its quota as
    the patterns can give, by the cheapest set of copies.
    """
    n_patterns, n_sources = len(tokens), len(quotas)
    start, end = 0, 1 + n_patterns + n_sources
    to, cap, cost, out = [], [], [], [[] for _ in range(end + 1)]

    def arc(a, b, c, w):
        for u, v, x, y in ((a, b, c, w), (b, a, 0, -w)):
            out[u].append(len(to))
            to.append(v), cap.append(x), cost.append(y)

    for p, t in enumerate(tokens):
        for k in range(copies):
            arc(start, 1 + p, t, k + 1)
    first = len(to)
    for p, own in enumerate(members):
        for s in own:
            arc(1 + p, 1 + n_patterns + s, tokens[p] * copies, 0)
    for s, q in enumerate(quotas):
        arc(1 + n_patterns + s, end, q, 0)
    level = [0] * (end + 1)
    while True:
        dist, via, queue = [None] * (end + 1), [None] * (end + 1), [(0, start)]
        dist[start] = 0
        while queue:
            d, u = heapq.heappop(queue)
            if d > dist[u]:
                continue
            for e in out[u]:
                v, reach = to[e], d + cost[e] + level[u] - level[to[e]]
                if cap[e] and (dist[v] is None or reach < dist[v]):
                    dist[v], via[v] = reach, e
                    heapq.heappush(queue, (reach, v))
        if dist[end] is None:
            break
        far = dist[end]
        level = [x + (far if d is None else min(d, far)) for x, d in zip(level, dist)]
        path, v = [], end
        while v != start:
            path.append(via[v])
            v = to[via[v] ^ 1]
        step = min(cap[e] for e in path)
        for e in path:
            cap[e] -= step
            cap[e ^ 1] += step
    flow, e = [], first
    for own in members:
        flow.append([cap[e + 2 * i + 1] for i in range(len(own))])
        e += 2 * len(own)
    return flow


def route_capacity(patterns: DataFrame, targets: DataFrame, max_repeats: int = 2) -> DataFrame:
    """(pattern, source, words): the min-cost flow from ``patterns`` (pattern, members, tokens) to the
    sources' quotas (``targets``, whole words).

    A component is solved by one task; one of more than ``MAX_ARCS`` arcs is an error, as it
    is a bound on overlaps, not on documents: a source that shares no document is a component
    of its own whatever its size.
    """
    links = patterns.select(F.col("members")[0].alias("a"), F.explode("members").alias("b")).where("a <> b").distinct()
    member = patterns.select("pattern", "tokens", F.col("members")[0].alias("head"), F.explode("members").alias("source"))
    if links.isEmpty():
        member, t = member.withColumn("component", F.col("head")), targets.withColumn("component", F.col("source"))
    else:
        roots = connected_components(links)
        member = member.join(roots, F.col("head") == F.col("node"), "left").withColumn("component", F.coalesce("root", "head"))
        t = targets.join(roots, F.col("source") == F.col("node"), "left").withColumn("component", F.coalesce("root", "source"))
    member = member.select("component", "pattern", "tokens", "source")
    t = t.select("component", "source", F.floor("target").cast("long").alias("quota"))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows > MAX_ARCS:
            raise ValueError(f"more than {MAX_ARCS} links between patterns and sources in one component")
        left = left.sort_by([("pattern", "ascending"), ("source", "ascending")])
        names = {s: i for i, s in enumerate(right["source"].to_pylist())}
        tokens, members, keys = [], [], []
        for p, n, s in zip(*(left[c].to_pylist() for c in ("pattern", "tokens", "source"))):
            if not keys or keys[-1] != p:
                keys.append(p), tokens.append(n), members.append([])
            members[-1].append(names[s])
        flow = min_cost_flow(tokens, members, right["quota"].to_pylist(), max_repeats)
        return pa.table({"pattern": left["pattern"], "source": left["source"],
                         "words": pa.array([w for own in flow for w in own], pa.int64())})

    return member.groupBy("component").cogroup(t.groupBy("component")).applyInArrow(
        solve, "pattern string, source string, words long")


def select_documents(sized: DataFrame, given: DataFrame, refills: int = REFILLS) -> DataFrame:
    """``sized`` (pattern, size, seed, ...) with ``copies``, so that each pattern's copies come to its words.

    ``given`` (pattern, tokens, words): whole copies of the pattern go to all its documents; of the
    rest the documents take one more in the order of ``seed`` (then size) while they fit.
    A document too long for what is left is passed over, and ``refills - 1`` further passes
    fill the gap from the documents that still fit.
    """
    whole = F.coalesce(F.when(F.col("tokens") > 0, F.floor(F.col("words") / F.col("tokens"))), F.lit(0)).cast("long")
    rows = sized.join(given.select("pattern", whole.alias("base"), F.coalesce(
        F.when(F.col("tokens") > 0, F.col("words") - whole * F.col("tokens")), F.lit(0)).alias("rest")), "pattern")
    rows = _stored(rows.withColumn("extra", F.lit(0)), "mix-pick")
    done = None
    for k in range(refills):
        fits = (F.col("extra") == 0) & (F.col("size") > 0) & (F.col("size") <= F.col("rest"))
        out, rows = rows.where(~fits), rows.where(fits)
        done = out if done is None else done.unionByName(out)
        rows = _stored(positions(_stored(rows, "mix-fits"), ["pattern"], ["seed", "size"], "size").withColumn(
            "extra", F.when(F.col("before") + F.col("size") <= F.col("rest"), 1).otherwise(0)).drop("position", "before"), "mix-pick")
        if k + 1 < refills:
            used = rows.where("extra = 1").groupBy("pattern").agg(F.sum("size").alias("used"))
            rows = rows.join(used, "pattern", "left").withColumn("rest", F.col("rest") - F.coalesce("used", F.lit(0))).drop("used")
    rows = done.unionByName(rows)
    return rows.withColumn("copies", F.col("base") + F.col("extra")).drop("base", "rest", "extra")


def mix_sources(sized: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, max_repeats: int = 2,
                refills: int = REFILLS) -> tuple[DataFrame, DataFrame]:
    """Copies of documents that bring every source near its target (see ``source_targets``).

    ``sized``: ``members`` (array of source keys, see ``source_key``), ``size`` (words) and ``seed`` (a
    string that orders the documents of a pattern, such as a keyed digest of the id), with any
    further columns, whatever their names.  Result: one row per input row (its columns and
    ``copies``, 0 to ``max_repeats``) and the sources with their targets.

    Defined cases: a row whose ``members`` is null or empty belongs to no source and gets no copy;
    a source named twice in ``members`` counts once; a size of 0 gets the whole copies of its
    pattern; equal rows are interchangeable, so the rows of a rerun are the same; an empty
    table gives an empty table.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in sized.columns]).alias("row")
    own = F.sort_array(F.array_distinct(F.coalesce("members", F.array().cast("array<string>")))).alias("members")
    given_columns = [c for c in sized.columns if c != "copies"]
    sized = sized.select(own, "size", "seed", row).withColumn("pattern", F.to_json("members"))
    sized = _stored(sized, "mix-sizes")
    patterns = _stored(sized.groupBy("pattern").agg(F.first("members").alias("members"), F.sum("size").alias("tokens")),
                       "mix-patterns")
    sizes = patterns.select(F.explode("members").alias("source"), "tokens").groupBy("source").agg(
        F.sum("tokens").alias("source_size"))
    total = patterns.where(F.size("members") > 0).agg(F.sum("tokens").alias("n")).first()["n"] or 0
    targets = _stored(source_targets(sizes, total, weights, share, max_repeats), "mix-targets")
    routed = route_capacity(patterns, targets, max_repeats).groupBy("pattern").agg(F.sum("words").alias("words"))
    given = _stored(patterns.select("pattern", "tokens").join(routed, "pattern", "left").fillna(0, ["words"]), "mix-given")
    picked = select_documents(sized.drop("members"), given, refills)
    return picked.select(*[F.col("row").getField(c).alias(c) for c in given_columns], "copies"), targets
