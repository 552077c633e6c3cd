"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are byte n-grams of lower-cased words with their boundaries.  Each is hashed to
a row of an embedding table; a text is the mean of its rows, classified by a linear
softmax.  Training is stochastic gradient descent in numpy on a bounded sample of labelled
rows, whose subword counts are made by Spark; a part of the sample is set aside to fit the
temperature of the scores and the threshold of rejection.

For prediction the embeddings are multiplied with the softmax weights once, which gives one
row of class scores per subword: a text's scores are their mean.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewell.llm.textops import Batch, LOWER, U64, slices

BUCKETS = 1 << 14
SIZES = (1, 2, 3, 4)
DIM = 16
TRAIN_ROWS = 4000          # bound of the training sample over all languages
EPOCHS, RATE, BATCH = 12, 20.0, 32
MAX_LANGUAGES = 200        # the most frequent labels are learned
QUANTILE, MARGIN = 0.002, 0.8   # thresholds: this share of this low quantile of rightly classified set-aside texts,
                                # and never less than no evidence at all
UNKNOWN = "und"
_LETTER = r"\p{L}"
_BYTES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)

# word bytes: letters of any script; all else ends a word
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x41:0x5B] = WORD_BYTES[0x80:] = True


def subwords(texts) -> tuple[np.ndarray, np.ndarray]:
    """(hash bucket of every subword, number of subwords up to each text)."""
    b = Batch(texts, WORD_BYTES)
    if not len(b.starts):
        return np.zeros(0, np.int64), np.zeros(b.n + 1, np.int64)
    # words laid out with one boundary byte before each and one at the end
    length = b.ends - b.starts
    at = np.r_[0, np.cumsum(length + 1)]
    line = np.full(at[-1] + 1, 0x20, np.uint8)
    inside = np.ones(at[-1] + 1, bool)
    inside[at] = False
    source = np.arange(at[-1])[inside[:-1]] - np.repeat(at[:-1] + 1 - b.starts, length)
    line[:-1][inside[:-1]] = LOWER[b.data[source]]
    code = _BYTES[line]
    count = np.zeros(b.n + 1, np.int64)
    out, owner = [], []
    first = at[b.first]                      # layout position of each text's first word
    h = np.zeros(len(line), U64)
    for size in range(1, max(SIZES) + 1):
        h = h[:len(line) - size + 1] * U64(0x9E3779B97F4A7C15) + code[size - 1:]
        if size not in SIZES:
            continue
        # no n-gram runs over a boundary: only its first and last byte may be one
        ok = np.ones(len(h), bool)
        for k in range(1, size - 1):
            ok &= inside[k:k + len(h)]
        if size == 1:
            ok &= inside[:len(h)]
        # nor over the end of a text: a boundary as last byte belongs to the next word
        pos = np.flatnonzero(ok)
        out.append((((h[pos] + U64(size)) * U64(0xD6E8FEB86659FD93)) >> U64(64 - BUCKETS.bit_length() + 1)).astype(np.int64))
        owner.append(np.minimum(np.searchsorted(first, pos, "right") - 1, b.n - 1))
    owner, out = np.concatenate(owner), np.concatenate(out)
    order = np.argsort(owner, kind="stable")
    count[1:] = np.cumsum(np.bincount(owner, minlength=b.n))
    return out[order], count


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    scores: np.ndarray        # [BUCKETS, languages]: embeddings times softmax weights
    bias: np.ndarray
    temperature: float
    thresholds: np.ndarray    # evidence below is rejected: by the logarithm of the number of subwords

    def predict(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(probability of each language, whether the text is in none of them) of each text.

        The evidence for the likeliest language is its mean subword score before the softmax:
        a probability compares the learned languages with each other and is high for one of them
        in any other language as well, the mean score is not.
        """
        bucket, bound = subwords(texts)
        n = np.diff(bound)
        total = np.zeros((len(n), len(self.languages)))
        some = np.flatnonzero(n)
        if len(some):
            total[some] = np.add.reduceat(self.scores[bucket], bound[some], axis=0) / n[some, None]
        size = np.minimum(np.log2(np.maximum(n, 1)).astype(int), len(self.thresholds) - 1)
        return _softmax((total + self.bias) / self.temperature), _evidence(total) < self.thresholds[size]


def _evidence(total: np.ndarray) -> np.ndarray:
    """How far the best mean score is above the mean of all languages' scores."""
    return total.max(axis=1) - total.mean(axis=1)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _sample(docs: DataFrame, id_col: Column, text: Column, lang: Column, rows: int) -> list:
    """Subword counts of at most ``rows`` labelled texts, evenly from the most frequent languages, by hash.

    The cut of each language follows from its count, so no task sees all rows of a language;
    equal rows are one.
    """
    d = docs.select(F.xxhash64(id_col.cast("string"), text).alias("h"), text.alias("text"), lang.alias("lang")).where(
        "lang IS NOT NULL AND text IS NOT NULL")
    size = d.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not size:
        return []
    per = max(1, rows // len(size))
    # a little more than ``per`` rows are expected below each cut; the smallest hashes of them are taken
    cut = F.create_map(*[x for r in size for x in (F.lit(r["lang"]), F.lit(min(1.0, (1.2 * per + 50) / r["count"])))])
    at = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))
    d = d.where(at < F.coalesce(F.try_element_at(cut, F.col("lang")), F.lit(0.0))).groupBy("h", "lang").agg(F.first("text").alias("text"))

    def counts(batches):
        for batch in slices(batches, "text"):
            bucket, bound = subwords(batch.column("text"))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bound))
            key, n = np.unique(owner * BUCKETS + bucket, return_counts=True)
            at = np.searchsorted(key // BUCKETS, np.arange(batch.num_rows + 1))
            key, n = (key % BUCKETS).astype(np.uint16), n.astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("lang"), pa.array(np.diff(bound), pa.int64()),
                 pa.array([key[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                 pa.array([n[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())], ["h", "lang", "total", "key", "n"])

    found = d.mapInArrow(counts, "h long, lang string, total long, key binary, n binary").collect()
    found.sort(key=lambda r: (r["h"] % (1 << 64), r["lang"]))
    taken: dict[str, int] = {}
    out = []
    for r in found:
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= per:
            out.append(r)
    return out


def train_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                         rows: int = TRAIN_ROWS, seed: int = 11) -> LanguageModel:
    """Fit on at most ``rows`` rows with a language (the smallest hashes of id and text of each of the
    ``MAX_LANGUAGES`` most frequent languages, whole texts); every fifth of them is set aside to calibrate
    the scores and the thresholds of rejection.

    Rows without a text or language teach nothing; repeated rows count once; a repeated id with
    another text is another row; equal counts of languages go by name; an empty table gives a
    model without languages, which rejects everything.
    """
    sample = _sample(docs, F.col(id_col), F.col(text_col), F.col(lang_col), rows)
    sample = [r for r in sample if len(r["key"])]
    languages = tuple(sorted({r["lang"] for r in sample}))
    if not languages:
        return LanguageModel((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, np.ones(1))
    label = np.array([languages.index(r["lang"]) for r in sample])
    rows_ = [(np.frombuffer(r["key"], np.uint16).astype(np.int64), np.frombuffer(r["n"], np.float32)) for r in sample]
    rows_ = [(k, n / n.sum()) for k, n in rows_]
    held = np.arange(len(rows_)) % 5 == 4
    if held.all() or not held.any():
        held[:] = False
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((DIM, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    train = np.flatnonzero(~held)
    # languages weigh alike however many rows they have
    weight = (len(train) / len(languages) / np.maximum(np.bincount(label[train], minlength=len(languages)), 1))[label]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(train)
        for a in range(0, len(order), BATCH):
            some = order[a:a + BATCH]
            mean = np.stack([rows_[i][1] @ emb[rows_[i][0]] for i in some])
            grad = _softmax(mean @ out + bias)
            grad[np.arange(len(some)), label[some]] -= 1
            grad *= (weight[some] / len(some))[:, None]
            back = grad @ out.T
            for g, i in zip(back, some):
                k, share = rows_[i]
                emb[k] -= rate * share[:, None] * g
            out -= rate * 0.1 * (mean.T @ grad).astype(np.float32)
            bias -= rate * 0.01 * grad.sum(0).astype(np.float32)
    scores = (emb @ out).astype(np.float32)
    seen = np.zeros(BUCKETS, bool)
    for i in train:
        seen[rows_[i][0]] = True
    scores[~seen] = 0.0         # what no training text holds says nothing
    judge = np.flatnonzero(held) if held.any() else train
    logits = np.stack([rows_[i][1] @ scores[rows_[i][0]] for i in judge]) + bias
    right = label[judge]

    def loss(t: float) -> float:
        return -np.log(np.maximum(_softmax(logits / t)[np.arange(len(judge)), right], 1e-12)).mean()
    temperature = min(np.geomspace(0.05, 20, 60), key=loss)
    thresholds = _thresholds([rows_[i] for i in judge], right, scores, bias, rng)
    return LanguageModel(languages, scores, bias, float(temperature), thresholds)


def _thresholds(rows: list, right: np.ndarray, scores: np.ndarray, bias: np.ndarray, rng) -> np.ndarray:
    """Evidence wanted of texts of 2**k subwords and more, from draws of so many subwords of each set-aside text.

    Evidence varies more in short texts, so each length has its own threshold: a low quantile over
    the draws that are classified rightly (one mislabelled text does not move it), with a
    margin.  With one language there is nothing to compare, and nothing is rejected.
    """
    if len(bias) < 2:
        return np.full(1, -np.inf)
    out = []
    for k in range(11):
        total = np.stack([scores[rng.choice(key, 1 << k, p=share / share.sum())].mean(axis=0) for key, share in rows])
        best = _evidence(total)[(total + bias).argmax(axis=1) == right]
        out.append(max(0.0, MARGIN * float(np.quantile(best, QUANTILE, method="lower"))) if len(best) else 0.0)
    return np.array(out)


def identify_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
                       *keep: Column) -> DataFrame:
    """``doc_id``, ``keep``, ``lang_pred``, ``score`` (calibrated probability) and ``rejected``, one row per input row.

    A null text or one without a letter is ``und`` with score 0 and rejected; so is every text
    when no language was learned.  Other texts get the likeliest language and are rejected
    where the evidence for it is below the model's threshold for their length.  Ids may repeat or be null; equal scores go to the
    alphabetically first language; an empty table gives an empty table; other columns are read only
    when kept, whatever their names.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = F.struct(F.col(id_col).alias("doc_id"), *keep).alias("kept")
    d = docs.select(kept, F.col(text_col).alias("_text"), F.coalesce(F.col(text_col).rlike(_LETTER), F.lit(False)).alias("_letter"))
    out_type = T.StructType([d.schema["kept"]] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType())])

    def predict(batches):
        m = shared.value
        names = np.array([*m.languages, UNKNOWN], object)
        for batch in slices(batches, "_text"):
            letter = batch.column("_letter").to_numpy(zero_copy_only=False)
            if m.languages:
                p, outside = m.predict(batch.column("_text"))
                best = np.where(letter, p.argmax(axis=1), len(m.languages))
                score = np.where(letter, p.max(axis=1), 0.0)
            else:
                best, score, outside = np.zeros(batch.num_rows, int), np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(names[best], pa.string()), pa.array(score.astype(float)),
                 pa.array((best == len(m.languages)) | outside)], schema=to_arrow_schema(out_type))

    return d.mapInArrow(predict, out_type).select("kept.*", "lang_pred", "score", "rejected")
