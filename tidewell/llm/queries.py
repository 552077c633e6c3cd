"""Registered queries of the subpackage: ``opN_<name>`` and ``pipeline``, with their oracle SQL.

Each reads its whole table; the digest columns are derived from the operator's output.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORDS_SQL = r"""
w AS (SELECT doc_id, text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
      FROM documents)
"""


@query("op1_substring_dedup", rf"""
WITH {_WORDS_SQL.strip()},
h AS (SELECT doc_id, ws, CASE WHEN len(ws) >= 35 THEN
             list_transform(range(1, len(ws) - 33), lambda i: md5(array_to_string(ws[i:i + 34], ' '))) ELSE [] END AS hs FROM w),
win AS (SELECT doc_id, unnest(hs) AS v, unnest(range(1, len(hs) + 1)) AS i FROM h),
rep AS (SELECT v FROM win GROUP BY v HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win SEMI JOIN rep USING (v), range(0, 35) t(k)),
g AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN n IS NULL THEN array_to_string(ws, ' ')
              ELSE coalesce(array_to_string(list_transform(list_filter(range(1, len(ws) + 1),
                     lambda i: NOT list_contains(ps, i)), lambda i: ws[i]), ' '), '') END) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)
""")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.substring_dedup import dedup_substrings
    out = dedup_substrings(table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


_DISTANCE_SQL = """
SELECT doc_id, lang, sqrt(greatest(sum(CASE WHEN p + q > 0 THEN -(p + q) / 2 * log2((p + q) / 2) ELSE 0 END)
  + (sum(CASE WHEN p > 0 THEN p * log2(p) ELSE 0 END) + sum(CASE WHEN q > 0 THEN q * log2(q) ELSE 0 END)) / 2, 0)) AS js
FROM {bins} GROUP BY doc_id, lang"""


@query("op9_quality_rules", rf"""
WITH {_WORDS_SQL.strip()},
t AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
h AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS v,
             unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM h SEMI JOIN (SELECT doc_id, v FROM h GROUP BY ALL HAVING count(*) > 1) USING (doc_id, v),
      range(0, 5) o(k) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS ls FROM t),
b AS (SELECT doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
             length(t.text) AS chars, length(regexp_replace(t.text, '[^0-9A-Z]', '', 'g')) AS marked,
             strlen(t.text) - length(t.text) AS wide
      FROM w JOIN t USING (doc_id) JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b),
c AS (SELECT lang, x, count(*) AS n FROM (SELECT lang, lower(unnest(ws)) AS x FROM w JOIN t USING (doc_id))
      WHERE lang IS NOT NULL AND length(x) <= 6 GROUP BY ALL),
k AS (SELECT lang, x FROM c QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, x) <= 12),
f AS (SELECT doc_id, d.x, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS y FROM w) JOIN (SELECT DISTINCT x FROM k) d
      ON y = d.x OR y = upper(d.x[1]) || d.x[2:] GROUP BY ALL),
g AS (SELECT lang, sum(chars) AS chars, sum(n_words) AS n_words, sum(marked) AS marked, sum(chars - word_chars) AS spaces,
             sum(n_symbols) AS n_symbols, sum(wide) AS wide FROM b WHERE lang IS NOT NULL GROUP BY lang),
q AS (SELECT k.lang, k.x, coalesce(sum(f.n), 0) / any_value(g.n_words) AS q FROM k JOIN g USING (lang)
      LEFT JOIN (f JOIN b USING (doc_id)) ON f.x = k.x AND b.lang = k.lang GROUP BY ALL),
j AS (SELECT * FROM v WHERE NOT base_failed AND n_words >= 50),
wb AS (SELECT doc_id, q.lang, coalesce(f.n, 0) / n_words AS p, q FROM j CROSS JOIN q LEFT JOIN f USING (doc_id, x)),
cb AS (SELECT doc_id, g.lang, unnest([j.marked, j.chars - j.word_chars, j.n_symbols, j.wide]) / j.chars AS p,
              unnest([g.marked, g.spaces, g.n_symbols, g.wide]) / g.chars AS q FROM j CROSS JOIN g),
wr AS (FROM wb UNION ALL SELECT doc_id, lang, greatest(0, 1 - sum(p)), greatest(0, 1 - sum(q)) FROM wb GROUP BY ALL),
cr AS (FROM cb UNION ALL SELECT doc_id, lang, greatest(0, 1 - sum(p)), greatest(0, 1 - sum(q)) FROM cb GROUP BY ALL),
wd AS ({_DISTANCE_SQL.format(bins="wr").strip()}), cd AS ({_DISTANCE_SQL.format(bins="cr").strip()}),
near AS (SELECT doc_id, min(greatest(cd.js / 0.3, wd.js / 0.45)) AS worst FROM wd JOIN cd USING (doc_id, lang) GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(worst <= 1, true) AS kept
FROM v LEFT JOIN near USING (doc_id)
""")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.quality import quality_rules
    return quality_rules(table(spark, sf_dir, "documents")).drop("char_js", "word_js")


@query("op10_chat_format", r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS head,
         length(text) + length(regexp_replace(text, '[^\\\[\]<]', '', 'g')) AS text_chars,
         length(role) + length(regexp_replace(role, '[^\\\[\]<]', '', 'g')) AS role_chars
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(7 + sum(text_chars + CASE WHEN head THEN 14 + role_chars ELSE 5 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""")
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.chat_format import format_chats, masked_text, read_turns
    said = "</s>[INST] ok [/INST]"
    own = spark.sql(f"SELECT -1L AS conv_id, 0L AS turn, 'user' AS role, '{said}' AS text "
                    f"UNION ALL SELECT -1L, 1L, 'assistant', '{said}'")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    f = format_chats(turns)
    f = f.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                 masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return f.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
        .alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BATCH_ROWS = 1000       # of whole texts and their ids in one Arrow batch: Spark's 10,000 are much for a small executor


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of at most ``rows`` rows, for the session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def byte_bpe(spark: SparkSession, path: str | None = None):
    """The production vocabulary and pattern; ``path`` names another rank file."""
    import public_tokenizers
    from tidewell.llm.byte_bpe import ByteBPE, ranks_file
    return ByteBPE(spark, ranks_file(path or public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN, space_led=True)


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.byte_bpe import bpe_encode, ids_text
    small_batches(spark)
    bpe = byte_bpe(spark)
    out = bpe_encode(table(spark, sf_dir, "documents").select("doc_id", "text"), bpe, decoded_col="decoded")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids_text(F.col("ids")), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op2_ngram_jaccard", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [md5(array_to_string(ws, ' ') || ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: md5(array_to_string(ws[i:i + 3], ' ')))) END AS hs FROM w),
n AS (SELECT doc_id, len(hs) AS n FROM s),
t AS (SELECT doc_id, unnest(hs) AS h FROM s),
shared AS MATERIALIZED (SELECT h, doc_id FROM t WHERE h IN (SELECT h FROM t GROUP BY h HAVING count(*) > 1)),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shared a JOIN shared b USING (h)
          WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
                       WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, c AS component_id FROM n JOIN comp ON a = doc_id
""")
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.ngram_jaccard import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


def held_out(id_col: str = "doc_id"):
    """True for the fifth of the ids that nothing may be learned from (a null id is held out)."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 5 == 0, F.lit(True))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.language_id import identify_languages, train_language_model
    docs = table(spark, sf_dir, "documents")
    model = train_language_model(docs.where(~held_out()))
    out = identify_languages(docs, model, "doc_id", "text", held_out().alias("held_out"))
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query("op6_decontaminate", r"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
il AS (SELECT item_id, ws, least(len(ws), 10) AS k FROM iw WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS v FROM il),
ks AS (SELECT DISTINCT k FROM il),
dh AS (SELECT doc_id, k, CASE WHEN len(ws) >= k THEN list_transform(range(1, len(ws) - k + 2),
         lambda i: array_to_string(ws[i:i + k - 1], ' ')) ELSE [] END AS hs FROM dw, ks),
dp AS (SELECT doc_id, k, unnest(hs) AS v, unnest(range(1, len(hs) + 1)) AS i FROM dh),
m AS (SELECT doc_id, dp.k, i, item_id FROM dp JOIN win USING (k, v)),
hit AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM m, range(0, 10) t(o) WHERE o < k GROUP BY doc_id),
it AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM m GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
""")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.decontaminate import find_contamination
    out = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.toxicity import score_toxicity, train_toxicity_model
    docs = table(spark, sf_dir, "documents")
    learn = table(spark, sf_dir, "labels").where(~held_out())
    model = train_toxicity_model(docs, learn)
    out = score_toxicity(docs, model, held_out().alias("held_out"))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


# Stands in for a secret that a deployment would pass in.
PII_KEY = "pseudonym-key-1"


@query("op5_pii_feistel")
def op5_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.pii import counts, pseudonymise
    out = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return out.select("doc_id", "text", F.size("pii_kinds").cast("long").alias("n_replaced"), *counts(F.col("pii_kinds")))


@query("op7_html_extract")
def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.llm.html_extract import extract_main_text
    out = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


# the queries over whole datasets register themselves
from tidewell.llm import dataset_queries  # noqa: E402,F401
