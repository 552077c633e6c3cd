"""Exact Jaccard self-join of word n-gram sets through a token-group matrix.

1. Tokens: texts are dealt into chunks; each chunk sends its distinct shingle hashes to hash
   buckets and learns which of them other texts hold too, and how widely (their weight).  A
   text can only have a partner if enough of its shingles are shared; the rest is done here.
2. Classes: texts with equal sets become one class, so copies cost one row.
3. Groups: classes are partitioned by a weighted minimum hash (widely shared shingles win),
   which puts most near copies into one group; large groups are split by size.
4. Matrix: one row for each (token, group), the union of what the members hold of their
   rarest tokens.  A linked pair shares one of either side's rarest tokens, so joining a
   class's own rarest tokens with the matrix finds every group that may hold a partner.
5. Bound, then open: a group's task counts how much of the query its whole token union
   covers; only groups covering the threshold are opened, where exact overlaps are
   counted over the members.  One link to each part of a group that already hangs together
   is enough for the components, so groups of copies never list their pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewell.llm.components import connected_components
from tidewell.llm.textops import Batch, U64, binary, chunk_texts, joined, mix, rolling
from tidewell.session import scratch_path

CHUNK_BYTES, MAX_CHUNK_BYTES = 2 << 20, 32 << 20
BUCKET_BYTES = 16 << 20
GROUP_TOKENS = 1 << 19      # token occurrences in one group before it is split
QUERY_TOKENS = 1 << 21      # token occurrences of the outside queries of one task


def shingle_sets(texts, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text of each set member, its hash, members of each text), sorted by text and hash.

    A text with fewer than ``n`` words, but not none, has its whole sequence as one shingle.
    """
    b = Batch(texts, lower=True)
    wh = b.hashes()
    at, h = b.windows(wh, n)
    doc = np.searchsorted(b.first, at, "right") - 1 if len(at) else at
    # empty texts share a start with the next one: searchsorted gives the last, which has the words
    for k in range(1, n):
        d = np.flatnonzero(b.n_words == k)
        if len(d):
            doc = np.r_[doc, d]
            h = np.r_[h, rolling(wh, k)[b.first[d]] + U64(k)]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])] if len(h) else np.zeros(0, bool)
    doc, h = doc[new], h[new]
    return doc, h, np.bincount(doc, minlength=b.n) if len(doc) else np.zeros(b.n, np.int64)


def _keys(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h & U64(0xFFFFFFFF)) % U64(buckets)) << U64(32)) | (h >> U64(32))


def _runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
    return at, np.diff(np.r_[at, len(a)])


def at_least(part, whole, num: int, den: int):
    return den * part >= num * whole


def _prefix(size: int, num: int, den: int) -> int:
    """How many of the rarest members of a set meet any set linked with it."""
    return size - (-(-num * size // den)) + 1


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                       num: int = 80, den: int = 100) -> DataFrame:
    """Components of texts linked where ``den * |intersection| >= num * |union|`` of their shingle sets.

    Result, one row per input row: ``doc_id``, ``n_shingles`` (set size), ``component_id`` (the
    smallest id reachable by links, itself included).  Text is lower-cased (A-Z); words are
    runs outside 0x20 and 0x09-0x0D.

    Defined cases: null, empty and blank texts have empty sets and no links; repeated rows
    are linked like other copies; a null id takes part in links but is never the
    smallest, and its row alone has a null component; an empty table gives an empty
    table; other columns are not read.  Shingles are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    texts, total = chunk_texts(docs, id_col, text_col, CHUNK_BYTES, MAX_CHUNK_BYTES)
    buckets = max(8, -(-total // BUCKET_BYTES))
    sets_path = scratch_path(spark, "jaccard-sets")
    _sets(texts, n, num, den, buckets).write.parquet(sets_path)
    sets = spark.read.parquet(sets_path)

    classes_path = scratch_path(spark, "jaccard-classes")
    (sets.where("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("least_id"), F.first("n_shingles").alias("n"), F.first("tokens").alias("tokens"),
        F.first("weights").alias("weights"))
     .withColumn("leader", _leader("tokens", "weights")).write.parquet(classes_path))
    classes = spark.read.parquet(classes_path)

    parts = classes.groupBy("leader").agg(F.ceil(F.sum("n") / GROUP_TOKENS).alias("parts"))
    grouped_path = scratch_path(spark, "jaccard-groups")
    (classes.join(parts, "leader")
     .withColumn("gid", F.xxhash64("leader", F.pmod(F.xxhash64("key"), F.col("parts"))))
     .select("key", "gid", "n", "tokens", "weights").write.parquet(grouped_path))
    # read twice: the two sides of the cogroup must be different relations
    edges = _links(spark.read.parquet(grouped_path), spark.read.parquet(grouped_path), num, den)
    roots = connected_components(edges)
    known = classes.select("key", "least_id").join(roots, F.col("key") == F.col("node"), "left")
    known = known.select("key", "least_id", F.coalesce("root", "key").alias("root"))
    named = known.join(known.groupBy("root").agg(F.min("least_id").alias("component_id")), "root").select("key", "component_id")
    linked = sets.where("key IS NOT NULL").join(named, "key", "left").select("doc_id", "n_shingles", "component_id")
    alone = sets.where("key IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone)


def _sets(texts: DataFrame, n: int, num: int, den: int, buckets: int) -> DataFrame:
    """doc_id, n_shingles and, for texts that can have a partner: key (of the whole set), tokens
    (hashes, rarest first) and weights (how widely each is held, 1: here only)."""
    id_type = texts.schema["doc_id"].dataType
    out_type = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_shingles", T.LongType()),
                             T.StructField("key", T.StringType()), T.StructField("tokens", T.BinaryType()),
                             T.StructField("weights", T.BinaryType())])

    def send(key, table):
        doc, h, _ = shingle_sets(table["text"], n)
        k = _keys(h, buckets)
        order = np.argsort(k, kind="stable")
        k, doc = k[order], doc[order]
        run, length = _runs(k)
        many = length > 1      # distinct within a text, so more than one text here
        k = k[run]
        at, size = _runs(k >> U64(32))
        low = (k & U64(0xFFFFFFFF)).astype(np.uint32)
        payload = [low[a:a + s].tobytes() + np.packbits(many[a:a + s]).tobytes() for a, s in zip(at.tolist(), size.tolist())]
        return pa.table({"bucket": (k[at] >> U64(32)).astype(np.int64), "chunk": np.full(len(at), key[0].as_py(), np.int32),
                         "n": size.astype(np.int32), "payload": binary(payload)})

    def weigh(key, table):
        low, many, row = [], [], []
        for i, (size, p) in enumerate(zip(table["n"].to_pylist(), table["payload"].to_pylist())):
            low.append(np.frombuffer(p, np.uint32, size))
            many.append(np.unpackbits(np.frombuffer(p, np.uint8, offset=4 * size), count=size))
            row.append(np.full(size, i))
        low, many, row = np.concatenate(low), np.concatenate(many), np.concatenate(row)
        order = np.argsort(low, kind="stable")
        run, length = _runs(low[order])
        weight = np.empty(len(low), np.int64)
        weight[order] = np.repeat(np.add.reduceat(1 + many[order].astype(np.int64), run), length)
        keep = weight > 1
        row, low, weight = row[keep], low[keep], np.minimum(weight[keep], 65535).astype(np.uint16)
        keys = (U64(key[0].as_py()) << U64(32)) | low.astype(U64)
        at, size = _runs(row)
        spans = [(a, a + s) for a, s in zip(at.tolist(), size.tolist())]
        chunk = table["chunk"].to_numpy()
        return pa.table({"chunk": chunk[row[at]].astype(np.int32), "keys": binary([keys[a:b].tobytes() for a, b in spans]),
                         "weights": binary([weight[a:b].tobytes() for a, b in spans])})

    def decide(key, left, right):
        if not left.num_rows:
            return to_arrow_schema(out_type).empty_table()
        doc, h, size = shingle_sets(left["text"], n)
        weight = np.ones(len(h), np.uint16)
        known = joined(right["keys"], np.uint64)
        if len(known) and len(h):
            order = np.argsort(known)
            known, w = known[order], joined(right["weights"], np.uint16)[order]
            k = _keys(h, buckets)
            at = np.minimum(np.searchsorted(known, k), len(known) - 1)
            found = known[at] == k
            weight[found] = w[at[found]]
        shared = np.bincount(doc, weight > 1, len(size)).astype(np.int64)
        keep = at_least(shared, size, num, den) & (size > 0)
        order = np.lexsort((h, weight, doc))
        h, weight = h[order], weight[order]
        bounds = np.r_[0, np.cumsum(size)]
        keys, tokens, weights = [], [], []
        for d, ok in enumerate(keep.tolist()):
            a, b = bounds[d], bounds[d + 1]
            x = h[a:b]
            keys.append(f"{int(mix(x).sum()):016x}{int(mix(x ^ U64(0x5851F42D4C957F2D)).sum()):016x}" if ok else None)
            tokens.append(x.tobytes() if ok else None)
            weights.append(weight[a:b].tobytes() if ok else None)
        return pa.table({"doc_id": left["doc_id"], "n_shingles": size.astype(np.int64), "key": pa.array(keys, pa.string()),
                         "tokens": pa.array(tokens, pa.binary()), "weights": pa.array(weights, pa.binary())})

    by_chunk = texts.groupBy("chunk")
    messages = by_chunk.applyInArrow(send, "bucket long, chunk int, n int, payload binary")
    answers = messages.groupBy("bucket").applyInArrow(weigh, "chunk int, keys binary, weights binary")
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(decide, out_type)


def _leader(tokens: str, weights: str):
    """The shingle that wins a race in which widely shared ones run faster (a weighted minimum hash)."""
    @F.arrow_udf("long")
    def leader(tokens: pa.Array, weights: pa.Array) -> pa.Array:
        out = []
        for t, w in zip(tokens.to_pylist(), weights.to_pylist()):
            t, w = np.frombuffer(t, np.uint64), np.frombuffer(w, np.uint16).astype(float)
            u = ((mix(t) >> U64(11)).astype(float) + 1) / 2.0**53
            out.append(int(t[np.argmin(np.where(w > 1, -np.log(u) / w**2, np.inf))].astype(np.int64)))
        return pa.array(out, pa.int64())
    return leader(F.col(tokens), F.col(weights))


def _links(grouped: DataFrame, members: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between class keys, enough of them to connect every component.  Both frames
    hold the classes with their groups."""
    @F.arrow_udf("array<long>")
    def rarest(tokens: pa.Array, weights: pa.Array) -> pa.Array:
        out = []
        for t, w in zip(tokens.to_pylist(), weights.to_pylist()):
            t, w = np.frombuffer(t, np.int64), np.frombuffer(w, np.uint16)
            p = _prefix(len(t), num, den)
            out.append(t[:p][w[:p] > 1])
        return pa.array(out, pa.list_(pa.int64()))

    rare = grouped.select("key", "gid", "n", F.explode(rarest("tokens", "weights")).alias("token"))
    matrix = rare.groupBy("token", "gid").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    size_ok = (den * F.col("high") >= num * F.col("n")) & (den * F.col("n") >= num * F.col("low"))
    found = (rare.join(matrix.withColumnRenamed("gid", "group"), "token").where(F.col("gid") < F.col("group"))
             .where(size_ok).select("key", "group").distinct())
    queries = found.join(grouped.select("key", "n", "tokens"), "key")
    # outside queries of one group are dealt into blocks; every block meets the whole group
    load = queries.groupBy("group").agg(F.ceil(F.sum("n") / QUERY_TOKENS).cast("int").alias("blocks"))
    members = (members.select(F.col("gid").alias("group"), "key", "tokens").join(load, "group", "left")
               .withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
               .select("group", "block", "key", "tokens"))
    queries = queries.join(load, "group").select(
        "group", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block"), "key", "tokens")

    def open_groups(key, left, right):
        a, b = [], []
        if left.num_rows:
            group = _Group(left, num, den)
            if left["block"][0].as_py() == 0:
                for i, r in enumerate(group.root.tolist()):
                    if i != r:
                        a.append(group.keys[i])
                        b.append(group.keys[r])
            for k, t in zip(right["key"].to_pylist(), right["tokens"].to_pylist()):
                t = np.frombuffer(t, np.uint64)
                if group.covers(t):
                    for r in np.unique(group.root[group.partners(t)]).tolist():
                        a.append(k)
                        b.append(group.keys[r])
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())})

    return (members.groupBy("group", "block").cogroup(queries.groupBy("group", "block"))
            .applyInArrow(open_groups, "a string, b string"))


class _Group:
    """Members of one group: token union, postings, and which members already hang together."""

    def __init__(self, table: pa.Table, num: int, den: int):
        self.num, self.den = num, den
        self.keys = table["key"].to_pylist()
        sets = [np.frombuffer(t, np.uint64) for t in table["tokens"].to_pylist()]
        self.size = np.array([len(s) for s in sets])
        token = np.concatenate(sets)
        member = np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(token, kind="stable")
        self.member = member[order]
        at, length = _runs(token[order])
        self.union, self.at, self.length = token[order][at], at, length
        self.root = np.arange(len(sets))
        # Once a part holds a quarter of the group it is pinned and its members ask no more:
        # whoever is outside it still asks for all.
        self.pinned = None
        for i in np.argsort(-self.size, kind="stable").tolist():
            if len(sets) > 1 and (self.pinned is None or self.root[i] != self.root[self.pinned]):
                self.join(i, self.partners(sets[i]))

    def join(self, i: int, partners: np.ndarray) -> None:
        parts = np.unique(self.root[np.r_[i, partners]])
        if len(parts) > 1:
            self.root[np.isin(self.root, parts[1:])] = parts[0]
            if self.pinned is None and 4 * int((self.root == parts[0]).sum()) >= len(self.root):
                self.pinned = i

    def _hits(self, tokens: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        return at[self.union[at] == tokens]

    def covers(self, tokens: np.ndarray) -> bool:
        """The bound: no member shares more of the query than the union does."""
        return bool(at_least(len(self._hits(tokens)), len(tokens), self.num, self.den))

    def partners(self, tokens: np.ndarray) -> np.ndarray:
        """Members linked with the query, by exact overlap."""
        hit = self._hits(tokens)
        start, length = self.at[hit], self.length[hit]
        total = int(length.sum())
        if not total:
            return np.zeros(0, np.int64)
        index = np.arange(total) + np.repeat(start - np.r_[0, np.cumsum(length)[:-1]], length)
        common = np.bincount(self.member[index], minlength=len(self.size))
        return np.flatnonzero((common > 0) & at_least(common, len(tokens) + self.size - common, self.num, self.den))
