"""A corpus cleaned in five stages, each written as Parquet and read again as the next one's documents.

Language ID, near duplicates, benchmark decontamination, pseudonyms, tokens.  Every stage works
on all rows the one before kept; all but the last return the columns of ``documents``.

Nulls and other cases: a null or empty text has no language and goes in the first stage; a null
or repeated id is no reason to go: rows count as duplicates by their texts alone, and rows that
are equal in every column as one; an empty table passes through as an empty table; further
columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.llm.byte_bpe import bpe_encode
from tidewell.llm.decontaminate import find_contamination
from tidewell.llm.language_id import identify_languages, train_language_model
from tidewell.llm.ngram_jaccard import jaccard_components
from tidewell.llm.pii import pseudonymise
from tidewell.llm.queries import PII_KEY, byte_bpe, held_out, table
from tidewell.session import scratch_path

# near duplicates: five-word shingles, similarity of 80 in 100
SHINGLE, SIMILAR = 5, 80
ROW_KEY = "_row_key"
# rows in one Arrow batch: whole rows with their texts travel through Python here, and long texts
# make Spark's default of 10,000 rows too large for a small executor
BATCH_ROWS = 1000
# SQL cannot express language identification or byte-level BPE: tests compare with plain versions
ORACLE_SQL = None


def _small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts that the calibrated model rejects.  The model is fitted on
    the labelled rows of the stage's own documents that are not held out."""
    _small_batches(spark)
    model = train_language_model(docs.where(~held_out()))
    out = identify_languages(docs, model, "doc_id", "text", _row(docs))
    return out.where(~F.col("rejected")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component of near duplicates: the one with the smallest id (a null id is after
    all others; of a repeated id, the smallest digest of the row).  Rows are told apart by a key of id
    and content, so rows of one id with different texts are different documents."""
    keyed = docs.withColumn(ROW_KEY, _row_key(docs))
    comp = jaccard_components(keyed, ROW_KEY, "text", SHINGLE, SIMILAR, 100)
    kept = comp.where("doc_id = component_id").select(F.col("doc_id").alias(ROW_KEY))
    # rows with one key are equal in every column
    return keyed.join(kept, ROW_KEY, "left_semi").dropDuplicates([ROW_KEY]).drop(ROW_KEY)


def _row_key(docs: DataFrame):
    """Sorts by id, null last, and tells rows with different contents apart."""
    content = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    id_ = F.coalesce(F.lpad(F.hex(F.col("doc_id").cast("long")), 16, "0"), F.lit("none"))
    return F.concat(id_, F.lit("-"), F.hex(F.xxhash64(*content)), F.lit("-"), F.md5(F.coalesce("text", F.lit(""))))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the passages of test items out of the texts; texts that are hardly anything else go."""
    _small_batches(spark)
    out = find_contamination(docs, table(spark, sf_dir, "benchmark"), _row(docs))
    return _with_text(out.where(~F.col("exceeds")), docs, "clean_text")


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms of the same format."""
    return _with_text(pseudonymise(docs.select(_row(docs), "text"), PII_KEY, "text", "new_text", None), docs, "new_text")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of the text, their number, and whether decoding them gives the text again."""
    _small_batches(spark)
    bpe = byte_bpe(spark)
    out = bpe_encode(docs.select("doc_id", "text"), bpe, decoded_col="decoded")
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


def _row(docs: DataFrame):
    """All columns as one struct, so that no name of theirs meets an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def _with_text(out: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` with another text; ``n_chars``, where there is one, follows it."""
    new = {"text": F.col(text)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(F.col(text)).cast(docs.schema["n_chars"].dataType)
    return out.select([new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


STAGES = [("language_id", language), ("ngram_jaccard", near_duplicates), ("decontamination", decontamination),
          ("pii", pseudonyms), ("byte_bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
