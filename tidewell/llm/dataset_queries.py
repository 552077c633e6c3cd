"""Registered queries 11 to 13 with their oracle SQL: periodic runs, source mixing, Merkle manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewell.llm.queries import _WORDS_SQL, query, table


def id_number(id_col: str = "doc_id") -> Column:
    """Unsigned CRC-32 of the id in decimal (null: null)."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8"))


# CRC-32 of the decimal doc_id: each byte is xor-ed in, then eight steps by the polynomial
_CRC_SQL = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1),
    lambda i: [ord(CAST(doc_id AS VARCHAR)[i]), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""


# a run of period q has 3q words that equal the word q later, so five or more in a row: such places are
# found by joining equal five-word sequences of one text, and stretches of them by gaps and islands
@query("op11_periodic_runs", rf"""
WITH {_WORDS_SQL.strip()},
c AS (SELECT doc_id, ws, len(ws) AS n, {_CRC_SQL} AS h FROM w),
l AS (SELECT doc_id, ws, n, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a, 3 + (h // 10) % 8 AS k FROM c),
m AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN ws ELSE list_transform(range(0, n), lambda i:
        ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // k) END]) END AS ws FROM l),
g AS (SELECT doc_id, n, unnest(range(0, n - 4)) AS i, unnest(list_transform(range(1, n - 3),
        lambda i: md5(array_to_string(ws[i:i + 4], ' ')))) AS v FROM m WHERE n >= 6),
p AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.v = y.v AND x.i < y.i
      WHERE 4 * (y.i - x.i) <= x.n),
t AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM p),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length FROM t GROUP BY doc_id, q, island),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= greatest(6, 4 * q) GROUP BY ALL),
b AS (SELECT doc_id, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs,
             first({{'start': start, 'length': length, 'period': period}} ORDER BY length DESC, start, period) AS best
      FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (SELECT doc_id, string_agg(v, ' ' ORDER BY i) AS text
         FROM (SELECT doc_id, unnest(ws) AS v, unnest(range(0, n)) AS i FROM m) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.start AS BIGINT) AS start, CAST(best.length AS BIGINT) AS length,
       CAST(best.period AS BIGINT) AS period, CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli,
       coalesce(runs, sha256('')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN kept USING (doc_id)
""")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.periodic_runs import periodic_runs
    out = periodic_runs(table(spark, sf_dir, "documents"), loop=id_number())
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))


MIX_SEED = "mix-1"


def _refill_sql(k: int) -> str:
    """One pass over the documents that are not taken yet and fit into what is left of their source."""
    return f"""
f{k} AS (SELECT doc_id, source, size, seed, sum(size) OVER (PARTITION BY source ORDER BY seed, size) AS upto, rest
         FROM s JOIN r{k} USING (source) WHERE size > 0 AND size <= rest {"AND doc_id NOT IN (SELECT doc_id FROM t" + str(k - 1) + ")" if k else ""}),
t{k} AS (SELECT doc_id, source, size FROM f{k} WHERE upto <= rest {"UNION ALL FROM t" + str(k - 1) if k else ""}),
r{k + 1} AS (SELECT g.source, g.rest - coalesce(u.n, 0) AS rest FROM r0 g LEFT JOIN (
             SELECT source, sum(size) AS n FROM t{k} GROUP BY source) u USING (source)),"""


# one source a document: the cheapest flow gives every source its target in whole words
@query("op12_mix_sources", rf"""
WITH {_WORDS_SQL.strip()},
s AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS source, len(ws) AS size,
             md5('{MIX_SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS seed FROM w JOIN documents USING (doc_id)),
z AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
q AS (SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source) - 1) % 3] AS DOUBLE) AS w,
             CAST(2 * source_size AS DOUBLE) AS cap FROM z),
o AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS room,
             sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS w_room, row_number() OVER (ORDER BY cap / w, source) AS i
      FROM q WINDOW before AS (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (SELECT min(i) AS i FROM o WHERE cap * w_room > w * room),
x AS (SELECT source, source_size, CASE WHEN i < coalesce((SELECT i FROM e), i + 1) THEN cap
             ELSE w * (SELECT o.room FROM o, e WHERE o.i = e.i) / (SELECT o.w_room FROM o, e WHERE o.i = e.i) END AS target FROM o),
b AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM x),
r0 AS (SELECT source, CAST(floor(target) AS BIGINT) - whole * source_size AS rest FROM b),{"".join(_refill_sql(k) for k in range(3))}
done AS (FROM t2)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (whole + CASE WHEN doc_id IN (SELECT doc_id FROM done) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM s JOIN b USING (source)
""")
def op12_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.mixing import mix_sources, source_key, word_counts
    seed = F.md5(F.concat(F.lit(f"{MIX_SEED}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    sized = word_counts(table(spark, sf_dir, "documents"), "doc_id", F.array(source_key(F.col("source"))).alias("members"),
                        seed.alias("seed"))
    rows, targets = mix_sources(sized)
    return rows.withColumn("source", F.col("members")[0]).join(targets, "source").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def _leaf_sql(text: str) -> str:
    part = "coalesce(strlen({0}) || ':' || {0}, '-')"
    values = [*(f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")), text]
    return f"sha256({' || '.join(part.format(v) for v in values)})"


@query("op13_merkle_manifest", rf"""
WITH RECURSIVE b AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
         CASE WHEN {_CRC_SQL} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS claimed,
         row_number() OVER (PARTITION BY coalesce('1' || source, '0') ORDER BY doc_id NULLS FIRST) - 1 AS r,
         coalesce('1' || source, '0') AS grp FROM documents),
lv AS (
  SELECT grp, 0 AS l, r, leaf AS d, count(*) OVER (PARTITION BY grp) AS n FROM b
  UNION ALL
  SELECT grp, l + 1, r // 3, sha256(string_agg(d, '' ORDER BY r)), (any_value(n) + 2) // 3 FROM lv WHERE n > 1 GROUP BY grp, l, r // 3),
sub AS (SELECT grp, d AS subroot, l AS h, row_number() OVER (ORDER BY grp) - 1 AS r, count(*) OVER () AS n FROM lv WHERE n = 1),
up AS (
  SELECT 0 AS l, r, subroot AS d, n FROM sub
  UNION ALL
  SELECT l + 1, r // 3, sha256(string_agg(d, '' ORDER BY r)), (any_value(n) + 2) // 3 FROM up WHERE n > 1 GROUP BY l, r // 3),
runs AS (SELECT grp, l, r // 3 AS run, list({{'r': r, 'd': d}} ORDER BY r) AS ds FROM lv WHERE n > 1 GROUP BY ALL),
ups AS (SELECT l, r // 3 AS run, list({{'r': r, 'd': d}} ORDER BY r) AS ds FROM up WHERE n > 1 GROUP BY ALL),
walk AS (
  SELECT doc_id, grp, 0 AS l, r, claimed AS cur, '' AS proof FROM b
  UNION ALL
  SELECT doc_id, walk.grp, walk.l + 1, walk.r // 3,
         sha256(array_to_string(list_transform(ds, lambda x: CASE WHEN x.r = walk.r THEN cur ELSE x.d END), '')),
         proof || array_to_string(list_transform(list_filter(ds, lambda x: x.r <> walk.r), lambda x: x.d), '')
  FROM walk JOIN runs ON runs.grp = walk.grp AND runs.l = walk.l AND runs.run = walk.r // 3),
climb AS (
  SELECT doc_id, 0 AS l, sub.r, cur, proof FROM walk JOIN sub ON sub.grp = walk.grp AND sub.h = walk.l
  UNION ALL
  SELECT doc_id, climb.l + 1, climb.r // 3,
         sha256(array_to_string(list_transform(ds, lambda x: CASE WHEN x.r = climb.r THEN cur ELSE x.d END), '')),
         proof || array_to_string(list_transform(list_filter(ds, lambda x: x.r <> climb.r), lambda x: x.d), '')
  FROM climb JOIN ups ON ups.l = climb.l AND ups.run = climb.r // 3),
top AS (SELECT d AS root, l FROM up WHERE n = 1)
SELECT b.doc_id, b.leaf, sub.subroot, top.root, sha256(climb.proof) AS proof_sha256, climb.cur AS folded_root, climb.cur = top.root AS verified
FROM b JOIN sub USING (grp) CROSS JOIN top JOIN climb ON climb.doc_id = b.doc_id AND climb.l = top.l
""")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.merkle import merkle_manifest
    docs = table(spark, sf_dir, "documents")
    out = merkle_manifest(docs, claimed={"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))},
                          claimed_where=id_number() % 2 == 0)
    return out.drop("siblings")
