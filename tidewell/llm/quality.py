"""Quality rules with Spark expressions only: counts, repeated windows, divergence from references.

References are histograms of each language over the whole table: character classes, and
the language's most common short words.  A text is compared with every reference by
Jensen-Shannon distance; it passes when some language is near in both histograms.
Texts below ``min_words`` are too short to judge by a histogram and pass this rule.

One pass finds the common words; a second writes the counts of every text (numbers only) to
the shared scratch folder, from which both the references and the verdicts are made.
"""

from __future__ import annotations

from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewell.session import scratch_path

SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS, SYMBOL_CHARS = " \t\n\x0b\x0c\r", "#*$%&|<>"
# counted classes: digits and capitals, white space, symbols, and further bytes of non-ASCII
# characters; the rest of a text is small letters and punctuation
CLASSES = ("marked", "spaces", "n_symbols", "wide")
COMMON_WORDS = 12
MAX_WORD_CHARS = 6
MIN_WORDS = 50
CHAR_LIMIT = 0.3
WORD_LIMIT = 0.45


def without(text: Column, chars: str) -> Column:
    """The text with the given characters deleted."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), chars, text)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


# words -> hashes of all 5-word windows, by joining hashes of neighbours: 1 + 1 = 2, 2 + 2 = 4, 4 + 1 = 5
_WINDOWS = (("h1", "transform(words, w -> xxhash64(w))"),
            ("h2", "zip_with(h1, slice(h1, 2, size(h1)), (a, b) -> xxhash64(a, b))"),
            ("h4", "zip_with(h2, slice(h2, 3, size(h2)), (a, b) -> xxhash64(a, b))"),
            ("hashes", "slice(zip_with(h4, slice(h1, 5, size(h1)), (a, b) -> xxhash64(a, b)), 1, greatest(0, size(h1) - 4))"))
# positions of hashes found twice or more, sorted, and the words that their windows cover
_REPEATS = """
CASE WHEN size(hashes) = size(array_distinct(hashes)) THEN 0L ELSE
  element_at(transform(array(sort_array(transform(hashes, (h, i) -> named_struct('h', h, 'i', i)))), s ->
    element_at(transform(array(sort_array(transform(
        filter(s, (e, k) -> coalesce(get(s, k - 1).h = e.h, false) OR coalesce(get(s, k + 1).h = e.h, false)),
        e -> e.i))), p ->
      aggregate(transform(p, (v, k) -> least(5, coalesce(get(p, k + 1) - v, 5))), 0L, (a, x) -> a + x)), 1)), 1)
END"""
# counts of the known words: in the sorted array, each word's first position gives its count
_KNOWN = """
element_at(transform(array(sort_array(transform(filter(words, w -> w IN ({forms})), w -> lower(w)))), c ->
  element_at(transform(array(array_distinct(c)), f ->
    element_at(transform(array(transform(f, w -> array_position(c, w))), at ->
      element_at(transform(array(map_from_arrays(f, transform(at, (a, i) -> coalesce(get(at, i + 1), size(c) + 1) - a))), m ->
        transform(array({known}), w -> coalesce(try_element_at(m, w), 0L))), 1)), 1)), 1)), 1)"""


def _quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)


def text_counts(docs: DataFrame, id_col: str, text_col: str, lang_col: str | None, known: list[str]) -> DataFrame:
    """The base counts of every text, its character classes and how often it has each known word."""
    lang = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    d = docs.select(F.col(id_col).alias("doc_id"), lang.alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumn("words", words_of(F.col("text")))
    for name, window in _WINDOWS:
        d = d.withColumn(name, F.expr(window))
    text, size = F.col("text"), F.length("text")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = {
        "n_words": F.size("words"), "word_chars": F.length(without(text, SPACE_CHARS)),
        "n_symbols": size - F.length(without(text, SYMBOL_CHARS)),
        "n_dup_lines": F.when(F.instr("text", "\n") == 0, F.lit(0)).otherwise(
            F.element_at(F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))), 1)),
        "n_repeat_words": F.expr(_REPEATS), "chars": size,
        "marked": size - F.length(F.regexp_replace(text, "[0-9A-Z]+", "")),
        "wide": F.octet_length(text) - size}
    found = F.expr(_KNOWN.format(known=_quoted(known), forms=_quoted(sorted({f for w in known for f in (w, w.capitalize())})))) \
        if known else F.array().cast("array<bigint>")
    return d.select("doc_id", "lang", *[c.cast("long").alias(k) for k, c in counts.items()], found.alias("found")) \
        .withColumn("spaces", F.col("chars") - F.col("word_chars"))


def common_words(docs: DataFrame, text_col: str, lang_col: str, count: int = COMMON_WORDS) -> dict[str, list[str]]:
    """Each language's most common words of up to MAX_WORD_CHARS characters, over the whole table
    (ties: the alphabetically first); ``count`` words a language come to the driver."""
    d = docs.select(F.col(lang_col).alias("lang"), F.explode(F.split(F.lower(F.col(text_col)), SPACES)).alias("w"))
    n = d.where(F.col("lang").isNotNull() & F.length("w").between(1, MAX_WORD_CHARS)).groupBy("lang", "w").count()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "w"))
    out: dict[str, list[str]] = {}
    for r in n.withColumn("rank", rank).where(F.col("rank") <= count).orderBy("lang", "rank").collect():
        out.setdefault(r["lang"], []).append(r["w"])
    return out


def references(counts: DataFrame, words: dict[str, list[str]], known: list[str]) -> list[dict]:
    """For each language the shares of its character classes and of its common words, each with the rest."""
    labelled = counts.where("lang IS NOT NULL")
    sums = labelled.groupBy("lang").agg(F.sum("chars").alias("chars"), F.sum("n_words").alias("n_words"),
                                        *[F.sum(c).alias(c) for c in CLASSES])
    found = {(r["lang"], r["pos"]): r["n"] for r in labelled.select("lang", F.posexplode("found").alias("pos", "n"))
             .groupBy("lang", "pos").agg(F.sum("n").alias("n")).collect()}
    out = []
    for r in sorted(sums.collect(), key=lambda r: r["lang"]):
        if not r["n_words"] or r["lang"] not in words:
            continue
        chars = [r[c] / r["chars"] for c in CLASSES]
        shares = [found[r["lang"], known.index(w)] / r["n_words"] for w in words[r["lang"]]]
        out.append({"lang": r["lang"], "words": words[r["lang"]], "chars": [*chars, max(0.0, 1 - sum(chars))],
                    "shares": [*shares, max(0.0, 1 - sum(shares))]})
    return out


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _entropy(values: Column) -> Column:
    return _total(F.transform(values, lambda x: F.when(x > 0, -x * F.log2(x)).otherwise(0.0)))


def js_distance(p: Column, q: list[float]) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of a histogram column of shares from fixed shares."""
    mean = F.zip_with(p, F.array(*[F.lit(float(x)) for x in q]), lambda a, b: (a + b) / 2)
    fixed = sum(-x * log2(x) for x in q if x > 0)
    return F.sqrt(F.greatest(_entropy(mean) - (_entropy(p) + fixed) / 2, F.lit(0.0)))


def with_rest(parts: list[Column], total: Column) -> Column:
    """An array of counts as shares of the total, the rest of it last."""
    shares = F.array(*[p / total for p in parts])
    return F.element_at(F.transform(F.array(shares), lambda s: F.concat(s, F.array(F.greatest(F.lit(0.0), 1 - _total(s))))), 1)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
                  min_words: int = MIN_WORDS, char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """doc_id, n_words, the base counts, base_failed, char_js, word_js (nearest language), kept.

    Defined cases: null and empty texts have no words and fail the base rule; an empty table
    gives an empty table; without labelled languages (``lang_col`` None, or null in every
    row) every text passes the divergence rule; ids may repeat or be null; other columns
    are not read.
    """
    words = common_words(docs, text_col, lang_col) if lang_col else {}
    known = sorted({w for ws in words.values() for w in ws})
    path = scratch_path(docs.sparkSession, "quality-counts")
    text_counts(docs, id_col, text_col, lang_col, known).write.parquet(path)
    d = docs.sparkSession.read.parquet(path)
    refs = references(d, words, known)
    d = d.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    if not refs:
        none = F.lit(None).cast("double")
        return d.select(*base, none.alias("char_js"), none.alias("word_js"), (~F.col("base_failed")).alias("kept"))
    judged = ~F.col("base_failed") & (F.col("n_words") >= min_words)
    chars = with_rest([F.col(c) for c in CLASSES], F.col("chars"))
    nearest = []
    for r in refs:
        shares = with_rest([F.col("found")[known.index(w)] for w in r["words"]], F.col("n_words"))
        c, w = js_distance(chars, r["chars"]), js_distance(shares, r["shares"])
        nearest.append(F.struct(F.greatest(c / char_limit, w / word_limit).alias("worst"), c.alias("c"), w.alias("w")))
    d = d.withColumn("js", F.when(judged, F.array_min(F.array(*nearest))))
    return d.select(*base, F.col("js.c").alias("char_js"), F.col("js.w").alias("word_js"),
                    (~F.col("base_failed") & F.coalesce(F.col("js.worst") <= 1, F.lit(True))).alias("kept"))
