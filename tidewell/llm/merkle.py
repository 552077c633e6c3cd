"""Merkle manifest of a dataset as a content-addressed graph, with a proof for every leaf.

A leaf is the digest of a row's fields.  The leaves of a group (a source), in the order of
their ids, form a tree whose nodes are the digests of up to three consecutive children; the
groups' roots, in the order of the groups, form a last tree in the same way.

Building: nodes meet in packs of up to 3**6 = 729 by their rank, so one exchange makes six
levels.  A pack stores a record digest -> children for each of its nodes and is itself
addressed by the digest of its top.  Proving: requests descend from the root.  A request
looks up the pack of the digest it stands at, follows the digits (base three) of its rank
through the records, and collects the children it does not select; what it has collected,
reversed, is the proof.  Requests that share a path share the row that descends, so the
root is looked up once and only the last step has a row per leaf.
"""

from __future__ import annotations

import hashlib
from typing import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewell.llm.positions import positions
from tidewell.session import scratch_path

ARITY, PACK_LEVELS = 3, 6
PACK = ARITY**PACK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(fields: Sequence[Column]) -> Column:
    """SHA-256 (hex) of the fields: ``-`` for null, else byte count, ``:`` and the value as text."""
    parts = []
    for f in fields:
        s = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def group_key(group: Column) -> Column:
    """A key that is never null and sorts like the group: null first, then bytewise."""
    return F.when(group.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), group.cast("string")))


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _height(n: Column) -> Column:
    """Levels above n leaves: the least h with 3**h >= n."""
    return F.size(F.filter(F.array(*[F.lit(ARITY**k) for k in range(39)]), lambda p: p < n))


# ---- building ---------------------------------------------------------------------------

_PACKS = "grp string, rank long, digest string, height int, levels int, width int, records binary"


def _build_pack(table: pa.Table) -> pa.Table:
    """One pack: its top digest, and a record for each of its nodes."""
    table = table.sort_by("rank")
    nodes = table["digest"].to_pylist()
    height, width, levels = table["height"][0].as_py(), len(nodes), 0
    records = {}
    while levels < min(height, PACK_LEVELS):
        runs = [nodes[i:i + ARITY] for i in range(0, len(nodes), ARITY)]
        nodes = [_hash("".join(run)) for run in runs]
        records.update(zip(nodes, runs))
        levels += 1
    stored = b"".join(bytes.fromhex(node) + bytes([len(run)]) + bytes.fromhex("".join(run)) for node, run in sorted(records.items()))
    return pa.table({"grp": [table["grp"][0].as_py()], "rank": pa.array([table["rank"][0].as_py() // PACK], pa.int64()),
                     "digest": nodes, "height": pa.array([height - levels], pa.int32()), "levels": pa.array([levels], pa.int32()),
                     "width": pa.array([width], pa.int32()), "records": pa.array([stored], pa.binary())})


def _store_packs(nodes: DataFrame, tallest: int) -> list[DataFrame]:
    """The packs of all trees by stage, from ``nodes`` (grp, rank, digest, height) upwards."""
    spark, stages = nodes.sparkSession, []
    while True:
        block = F.floor(F.col("rank") / PACK).alias("block")
        packs = nodes.groupBy("grp", block).applyInArrow(_build_pack, _PACKS)
        path = scratch_path(spark, "merkle-packs")
        packs.write.parquet(path)
        stages.append(spark.read.parquet(path))
        tallest -= PACK_LEVELS
        if tallest <= 0:
            return stages
        nodes = stages[-1].where("height > 0").select("grp", "rank", "digest", "height")


def _tops(stages: list[DataFrame]) -> DataFrame:
    """(grp, digest, stage) of every tree's root."""
    out = None
    for k, packs in enumerate(stages):
        top = packs.where("height = 0").select("grp", "digest", F.lit(k).alias("stage"))
        out = top if out is None else out.unionByName(top)
    return out


# ---- proving ----------------------------------------------------------------------------

def _read_records(stored: bytes) -> dict[str, list[str]]:
    text, at, records = stored.hex(), 0, {}
    while at < len(text):
        n = int(text[at + 64:at + 66], 16)
        records[text[at:at + 64]] = [text[at + 66 + 64 * k:at + 130 + 64 * k] for k in range(n)]
        at += 66 + 64 * n
    return records


def _descend(records: dict[str, list[str]], top: str, levels: int, offset: int) -> tuple[str, list[tuple[str, str]]]:
    """From a pack's top down by the digits of an offset: the node reached and, level by level,
    the unselected children to the left and to the right."""
    node, segments = top, []
    for k in reversed(range(levels)):
        children = records[node]
        d = offset // ARITY**k % ARITY
        node = children[d]
        segments.append(("".join(children[:d]), "".join(children[d + 1:])))
    return node, segments


def _write_path(segments) -> str:
    return "".join(f"{left},{right};" for left, right in segments)


def _read_path(path: str) -> list[tuple[str, str]]:
    return [tuple(s.split(",")) for s in path.split(";")[:-1]]


_FRONTIER = "grp string, rank long, digest string, path string, subroot string"


def _expand(table: pa.Table) -> pa.Table:
    """The children of packs as rows of their own, each with its path from the root."""
    out = {c: [] for c in ("grp", "rank", "digest", "path", "subroot")}
    for r in table.to_pylist():
        records = _read_records(r["records"])
        for k in range(r["width"]):
            node, segments = _descend(records, r["digest"], r["levels"], k)
            for c, v in zip(out, (r["grp"], r["rank"] * PACK + k, node, r["path"] + _write_path(segments), r["subroot"])):
                out[c].append(v)
    return pa.table({c: pa.array(v, pa.int64() if c == "rank" else pa.string()) for c, v in out.items()})


def _look_up(frontier: DataFrame, packs: DataFrame) -> DataFrame:
    """The records under the digests that the requests stand at; equal digests have equal records."""
    by_digest = packs.groupBy("digest").agg(*[F.first(c).alias(c) for c in ("levels", "width", "records")])
    return frontier.join(by_digest, "digest")


def _children(frontier: DataFrame, packs: DataFrame) -> DataFrame:
    return _look_up(frontier, packs).groupBy("grp", "rank").applyInArrow(_expand, _FRONTIER)


def fold(leaf: str, proof: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings (bottom-up, left and right) give."""
    for left, right in proof:
        leaf = _hash(left + leaf + right)
    return leaf


def _answer(root: str, id_type: pa.DataType, with_siblings: bool):
    def answer(requests: pa.Table, above: pa.Table) -> pa.Table:
        pack = above.to_pylist()[0]
        records = _read_records(pack["records"])
        upper = _read_path(pack["path"])[::-1]
        upper_text = "".join(left + right for left, right in upper)
        seen: dict[str, str] = {}
        proofs, siblings, folded = [], [], []
        for rank, leaf, claimed in zip(*(requests[c].to_pylist() for c in ("rank", "leaf", "claimed"))):
            node, segments = _descend(records, pack["digest"], pack["levels"], rank % PACK)
            if node != leaf:
                raise ValueError("the manifest does not hold this leaf at its place")
            own = segments[::-1]
            proofs.append(_hash("".join(left + right for left, right in own) + upper_text))
            top = fold(claimed, own)
            if top not in seen:     # leaves that agree up to here share the rest of the way
                seen[top] = fold(top, upper)
            folded.append(seen[top])
            siblings.append([left + right for left, right in own + upper] if with_siblings else None)
        n = len(folded)
        return pa.table({"doc_id": requests["doc_id"].cast(id_type), "leaf": requests["leaf"], "subroot": [pack["subroot"]] * n,
                         "root": [root] * n, "siblings": pa.array(siblings, pa.list_(pa.string())),
                         "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string()),
                         "verified": pa.array([f == root for f in folded], pa.bool_())})
    return answer


def merkle_manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
                    claimed: dict[str, Column] | None = None, claimed_where: Column | None = None,
                    with_siblings: bool = False) -> DataFrame:
    """The manifest's root, and for each row its leaf, its proof and whether a claimed row passes it.

    ``claimed``: other values of fields; where ``claimed_where`` is true (default: everywhere) the
    row that is verified has these.  Result, one row per input row: ``doc_id``, ``leaf``,
    ``subroot`` (of the row's group), ``root``, ``siblings`` (level by level from the leaf to the root,
    hex digests joined; null unless ``with_siblings``), ``proof_sha256`` (of all siblings joined),
    ``folded_root`` (from the claimed leaf and the siblings) and ``verified``.

    Defined cases: null fields have a mark of their own; a null id sorts first, equal ids by their
    leaves, and equal rows are equal leaves next to each other; the null group is the first group;
    a group of one row is its own root, and a table of one row has an empty proof; texts of any
    length are digested whole; an empty table gives an empty table; other columns are not read.
    """
    spark = docs.sparkSession
    leaf = digest_of([F.col(f"`{f}`") for f in fields])
    other = leaf
    if claimed:
        other = digest_of([claimed.get(f, F.col(f"`{f}`")) for f in fields])
        if claimed_where is not None:
            other = F.when(claimed_where, other).otherwise(leaf)
    path = scratch_path(spark, "merkle-leaves")
    docs.select(F.col(id_col).alias("doc_id"), group_key(F.col(group_col)).alias("grp"), leaf.alias("leaf"),
                other.alias("claimed")).write.parquet(path)
    leaves = spark.read.parquet(path)
    id_field = leaves.schema["doc_id"]
    out_schema = (f"doc_id {id_field.dataType.simpleString()}, leaf string, subroot string, root string, "
                  "siblings array<string>, proof_sha256 string, folded_root string, verified boolean")
    sizes = leaves.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    bounds = sizes.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("groups")).first()
    if not bounds["groups"]:
        return spark.createDataFrame([], out_schema)

    def levels(n: int) -> int:
        return next(k for k in range(64) if ARITY**k >= n)

    ranked = positions(leaves, ["grp"], ["doc_id", "leaf"]).withColumnRenamed("position", "rank")
    nodes = ranked.join(sizes, "grp").select("grp", "rank", F.col("leaf").alias("digest"), _height(F.col("n")).alias("height"))
    stages = _store_packs(nodes, levels(bounds["most"]))
    tops = _tops(stages)
    groups = positions(_written(tops.withColumn("all", F.lit("")), "merkle-tops"), ["all"], ["grp"])
    group_nodes = groups.select(F.col("all").alias("grp"), F.col("position").alias("rank"), "digest",
                                F.lit(levels(bounds["groups"])).alias("height"))
    upper = _store_packs(group_nodes, levels(bounds["groups"]))
    root = upper[-1].where("height = 0").first()["digest"]

    at = spark.createDataFrame([("", 0, root, "", "")], _FRONTIER)
    for packs in reversed(upper):
        at = _children(at, packs)
    entry = _written(at.select(F.col("rank").alias("position"), F.col("digest").alias("subroot"), "path")
                     .join(groups.select("position", "grp", "stage"), "position")
                     .select("grp", F.lit(0).cast("long").alias("rank"), F.col("subroot").alias("digest"), "path", "subroot", "stage"),
                     "merkle-entries")
    at = None
    for k in reversed(range(len(stages))):
        here = entry.where(F.col("stage") == k).drop("stage")
        at = here if at is None else at.unionByName(here)
        if k:
            at = _written(_children(at, stages[k]), "merkle-frontier")
    above = _look_up(at, stages[0]).select("grp", F.col("rank").alias("block"), "digest", "path", "subroot", "levels", "records")
    asked = ranked.withColumn("block", F.floor(F.col("rank") / PACK))
    return asked.groupBy("grp", "block").cogroup(above.groupBy("grp", "block")).applyInArrow(
        _answer(root, to_arrow_type(id_field.dataType), with_siblings), out_schema)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
