"""Toxic spans by a linear-chain conditional random field.

Tokens are words (letters of any script, A-Z lower-cased).  Their features are the word, its
beginnings and its endings.  Features that training documents marked toxic hold far more
often than clean ones become the model's features, and tokens carrying one label the
training sequences: toxic in a toxic document, clean in a clean one.  The field has two
states, one weight for each feature, a bias and transitions, fitted by gradient steps on
its exact likelihood.

Scoring runs forward-backward over each text.  A token without a feature has the same
transfer matrix everywhere, so a run of such tokens is one precomputed matrix power and
only featured tokens are visited.  Their marginals give the document's score (calibrated on
the training documents) and the offsets of offending words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewell.llm.language_id import WORD_BYTES
from tidewell.llm.textops import Batch, U64, slices

PARTS = (3, 4, 5, 6, 7)         # bytes of beginnings and endings
TOXIC_ROWS, CLEAN_ROWS = 3000, 9000   # bound of the training sample
MIN_DOCS, MIN_EVIDENCE = 4, 11.0      # documents with a feature, and its log-likelihood ratio
CONTEXT = 8                     # tokens around a featured one in a training sequence
MOST_FEATURED, GROUP = 8, 1024  # featured tokens in one training sequence, sequences handled at once
STEPS, RATE, RIDGE = 120, 0.2, 0.01
POWERS = 512                    # longer runs have converged to the leading direction


def token_features(b: Batch) -> list[np.ndarray]:
    """One array per kind of feature: its hash for every token, 0 where a word is too short."""
    size = b.ends - b.starts
    out = [b.hashes()]
    for k in PARTS:
        fits = size > k
        for kind, (s, e) in enumerate(((b.starts, b.starts + k), (b.ends - k, b.ends))):
            h = np.zeros(len(size), U64)
            h[fits] = b.span_hashes(s[fits], e[fits]) + U64(2 * k + kind)
            out.append(h)
    return out


@dataclass(frozen=True)
class ToxicityModel:
    features: np.ndarray      # sorted hashes
    weights: np.ndarray       # of the toxic state
    bias: float
    transitions: np.ndarray   # [from, to]
    slope: float              # calibration of a document's evidence
    offset: float

    def table(self) -> np.ndarray:
        """Bits of the hashes' first 16 bits: most tokens are told apart by one look."""
        t = np.zeros(1 << 16, bool)
        t[(self.features >> U64(48)).astype(np.int64)] = True
        return t


def find_features(b: Batch, features: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token, feature index) of all features found, by token."""
    token, index = [], []
    if len(features):
        for h in token_features(b):
            at = np.flatnonzero(table[(h >> U64(48)).astype(np.int64)])
            pos = np.minimum(np.searchsorted(features, h[at]), len(features) - 1)
            ok = features[pos] == h[at]
            token.append(at[ok])
            index.append(pos[ok])
    if not token:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    token, index = np.concatenate(token), np.concatenate(index)
    order = np.lexsort((index, token))
    return token[order], index[order]


# ---- training --------------------------------------------------------------------------------

def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, toxic_col: str) -> DataFrame:
    """toxic, text of at most TOXIC_ROWS and CLEAN_ROWS labelled documents, by id hash.  The
    chosen ids are a few thousand rows, so they are broadcast."""
    known = (labels.where(F.col(toxic_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg((F.max(F.col(toxic_col).cast("int")) == 1).alias("toxic"))
             .withColumn("h", F.xxhash64("_id")))
    size = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    # a cut of the hash that a little more than the wanted rows are below, so that only those are ranked
    wanted = {True: TOXIC_ROWS, False: CLEAN_ROWS}
    part = {t: min(1.0, (1.2 * wanted[t] + 100) / n) for t, n in size.items()}
    at = F.col("h") / F.lit(float(1 << 64)) + 0.5
    chosen = (known.where(at <= F.when(F.col("toxic"), part.get(True, 1.0)).otherwise(part.get(False, 1.0)))
              .withColumn("k", F.row_number().over(Window.partitionBy("toxic").orderBy("h", "_id")))
              .where(F.col("k") <= F.when(F.col("toxic"), TOXIC_ROWS).otherwise(CLEAN_ROWS))
              .select("_id", F.col("toxic").cast("int").alias("toxic")))
    return (docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "_id").select("toxic", "text"))


def _feature_counts(keep: np.ndarray | None):
    """Documents with a feature, and which of 64 hash bins the words before it fall into."""
    def run(batches):
        for batch in slices(batches, "text"):
            b = Batch(batch.column("text"), WORD_BYTES, lower=True)
            kinds = 1 + 2 * len(PARTS)
            words = b.hashes()
            before = np.tile(U64(1) << (np.r_[U64(0), words[:-1]] & U64(63)), kinds) if len(words) else words
            h = np.concatenate(token_features(b)) if len(words) else words
            doc = np.tile(b.doc_of_word(), kinds)
            ok = h != 0 if keep is None else np.isin(h, keep)
            h, doc, before = h[ok], doc[ok], before[ok]
            order = np.lexsort((doc, h))
            h, doc, before = h[order], doc[order], before[order]
            run_ = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
            new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])].astype(np.int64) if len(h) else run_
            yield pa.RecordBatch.from_arrays([
                pa.array(h[run_].astype(np.int64)), pa.array(np.add.reduceat(new, run_) if len(h) else run_),
                pa.array((np.bitwise_or.reduceat(before, run_) if len(h) else h).astype(np.int64))], ["h", "n", "bins"])
    return run


def _count(sample: DataFrame, toxic: int, keep: np.ndarray | None, least: int) -> dict[int, float]:
    """Documents with each feature, or distinct words before it if they are fewer: near copies of
    one text repeat their contexts and do not count again."""
    rows = (sample.where(F.col("toxic") == toxic).mapInArrow(_feature_counts(keep), "h long, n long, bins long")
            .groupBy("h").agg(F.sum("n").alias("n"), F.bit_count(F.bit_or("bins")).alias("bins"))
            .where(F.col("n") >= least).where(F.col("bins") >= min(least, 48)).collect())
    if toxic == 0:
        return {r["h"]: float(r["n"]) for r in rows}
    return {r["h"]: min(float(r["n"]), -64 * np.log(1 - r["bins"] / 64) if r["bins"] < 60 else np.inf) for r in rows}


def _select_features(sample: DataFrame) -> np.ndarray:
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not size.get(1) or not size.get(0):
        return np.zeros(0, U64)
    share = size[1] / (size[0] + size[1])
    toxic = _count(sample, 1, None, MIN_DOCS)
    keep = np.array(sorted(toxic), np.int64).astype(U64)
    clean = _count(sample, 0, keep, 1)
    out = []
    for h, t in toxic.items():
        c = clean.get(h, 0)
        n = t + c
        evidence = t * np.log(t / n / share) + (c * np.log(c / n / (1 - share)) if c else 0.0)
        if t / n > min(0.9, 3 * share) and evidence > MIN_EVIDENCE:
            out.append(h)
    return np.sort(np.array(out, np.int64).astype(U64))


@dataclass
class Sequences:
    """Distinct training sequences of similar length and how often each occurs."""
    labels: np.ndarray      # [sequence, position], -1 as padding
    found: np.ndarray       # (sequence, position, feature) of all features
    times: np.ndarray


def _sequences(rows: list) -> list[Sequences]:
    """Featured tokens with their context, equal ones counted once, in groups of similar length."""
    seen: dict[tuple, int] = {}
    for r in rows:
        token, index = np.frombuffer(r["token"], np.int64), np.frombuffer(r["index"], np.int64)
        if not len(token):
            key = (0, min(r["n_words"], CONTEXT), (), ())
            seen[key] = seen.get(key, 0) + 1
            continue
        at = np.unique(token)
        # featured tokens nearer than two contexts share a sequence
        for near in np.split(at, np.flatnonzero(np.diff(at) > 2 * CONTEXT) + 1):
            for part in np.split(near, range(MOST_FEATURED, len(near), MOST_FEATURED)):
                lo, hi = max(0, part[0] - CONTEXT), min(r["n_words"], part[-1] + CONTEXT + 1)
                a, z = np.searchsorted(token, (part[0], part[-1] + 1))
                key = (r["toxic"], int(hi - lo), tuple((token[a:z] - lo).tolist()), tuple(index[a:z].tolist()))
                seen[key] = seen.get(key, 0) + 1
    ordered = sorted((k for k in seen if k[1]), key=lambda k: (k[1], k))
    out = []
    for start in range(0, len(ordered), GROUP):
        group = ordered[start:start + GROUP]
        labels = np.full((len(group), max(k[1] for k in group)), -1, np.int8)
        found = []
        for i, (toxic, size, token, index) in enumerate(group):
            labels[i, :size] = 0
            if token:
                labels[i, list(token)] = toxic
                found.append(np.stack([np.full(len(token), i), token, index]))
        out.append(Sequences(labels, np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64),
                             np.array([seen[k] for k in group], float)))
    return out


def _counts_of(s: Sequences, n_features: int, one: np.ndarray, pairs) -> np.ndarray:
    """Features, bias and transitions counted over the sequences: ``one`` is the weight of the toxic
    state at each position, ``pairs(a, b)`` that of each step from a to b."""
    out = np.zeros(n_features + 5)
    times = s.times[:, None]
    out[:n_features] = np.bincount(s.found[2], (one * times)[s.found[0], s.found[1]], n_features)
    out[n_features] = (one * times).sum()
    for a in (0, 1):
        for b in (0, 1):
            out[n_features + 1 + 2 * a + b] = (pairs(a, b) * times).sum()
    return out


def _expected(s: Sequences, weights: np.ndarray, n_features: int) -> np.ndarray:
    """Expected counts by forward-backward over all sequences at once."""
    real = s.labels >= 0
    n, size = real.shape
    emit = weights[n_features] + np.bincount(s.found[0] * size + s.found[1], weights[s.found[2]], n * size).reshape(n, size)
    t = weights[n_features + 1:].reshape(2, 2)
    alpha, beta = np.zeros((size, 2, n)), np.zeros((size, 2, n))
    alpha[0, 1] = emit[:, 0]
    for k in range(1, size):
        for to in (0, 1):
            alpha[k, to] = np.logaddexp(alpha[k - 1, 0] + t[0, to], alpha[k - 1, 1] + t[1, to]) + to * emit[:, k]
        alpha[k] = np.where(real[:, k], alpha[k], alpha[k - 1])
    for k in range(size - 2, -1, -1):
        for at in (0, 1):
            beta[k, at] = np.logaddexp(beta[k + 1, 0] + t[at, 0], beta[k + 1, 1] + t[at, 1] + emit[:, k + 1])
        beta[k] = np.where(real[:, k + 1], beta[k], 0)
    z = np.logaddexp(alpha[-1, 0], alpha[-1, 1])
    one = np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - z, 0)).T * real

    def pairs(a, b):
        p = (alpha[:-1, a] + beta[1:, b] - z).T + t[a, b] + b * emit[:, 1:]
        return np.exp(np.minimum(p, 0)) * real[:, 1:]
    return _counts_of(s, n_features, one, pairs)


def _fit(groups: list[Sequences], n_features: int) -> tuple[np.ndarray, float, np.ndarray]:
    """Gradient ascent (Adam) on the mean log likelihood of the sequences."""
    weights = np.zeros(n_features + 5)     # features, bias, transitions 00 01 10 11
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    observed = np.zeros_like(weights)
    for s in groups:
        y = s.labels

        def pairs(a, b):
            return ((y[:, :-1] == a) & (y[:, 1:] == b)).astype(float)
        observed += _counts_of(s, n_features, (y == 1).astype(float), pairs)
    total = sum(s.times.sum() for s in groups)
    for step in range(1, STEPS + 1):
        grad = (observed - sum(_expected(s, weights, n_features) for s in groups)) / total - RIDGE / total * weights
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        weights += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return weights[:n_features], float(weights[n_features]), weights[n_features + 1:].reshape(2, 2)


def _calibrate(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over log evidence, by Newton steps with a small ridge."""
    x = np.stack([np.log(evidence + 1e-6), np.ones(len(evidence))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - toxic) + np.array([1e-2, 1e-3]) * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-3])
        w = w - np.clip(np.linalg.solve(h, g), -2, 2)
    return float(w[0]), float(w[1])


def train_toxicity_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         toxic_col: str = "toxic") -> ToxicityModel:
    """Fit on at most TOXIC_ROWS toxic and CLEAN_ROWS clean documents (smallest id hashes, whole
    texts).  Without documents of both kinds the model scores every text by its offset."""
    sample = _sample(docs, labels, id_col, text_col, toxic_col)
    features = _select_features(sample)
    empty = ToxicityModel(features, np.zeros(len(features)), -5.0, np.zeros((2, 2)), 1.0, 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(features)

    def events(batches):
        f = shared.value
        table = ToxicityModel(f, f, 0.0, f, 0.0, 0.0).table()
        for batch in slices(batches, "text"):
            b = Batch(batch.column("text"), WORD_BYTES, lower=True)
            token, index = find_features(b, f, table)
            at = np.searchsorted(token, b.first)
            yield pa.RecordBatch.from_arrays([
                batch.column("toxic"), pa.array(b.n_words.astype(np.int64)),
                pa.array([(token[a:z] - s).tobytes() for a, z, s in zip(at, at[1:], b.first)], pa.binary()),
                pa.array([index[a:z].tobytes() for a, z in zip(at, at[1:])], pa.binary())], ["toxic", "n_words", "token", "index"])

    rows = sample.mapInArrow(events, "toxic int, n_words long, token binary, index binary").collect()
    rows = sorted(rows, key=lambda r: (r["toxic"], r["n_words"], bytes(r["token"]), bytes(r["index"])))
    if not rows:
        return empty
    if not len(features):
        toxic = np.array([r["toxic"] for r in rows])
        odds = (toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 0.5)
        return ToxicityModel(features, np.zeros(0), -5.0, np.zeros((2, 2)), 0.0, float(np.log(odds)))
    weights, bias, transitions = _fit(_sequences(rows), len(features))
    model = ToxicityModel(features, weights, bias, transitions, 1.0, 0.0)
    chain = Chain(model)
    evidence = np.array([chain.evidence(*chain.marginals(np.frombuffer(r["token"], np.int64),
                                                          np.frombuffer(r["index"], np.int64), r["n_words"]))
                         for r in rows])
    slope, offset = _calibrate(evidence, np.array([r["toxic"] for r in rows], float))
    return ToxicityModel(features, weights, bias, transitions, slope, offset)


# ---- scoring ---------------------------------------------------------------------------------

class Chain:
    """Forward-backward over the featured tokens of a text."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        t = np.exp(model.transitions - model.transitions.max())
        plain = t * np.exp([0.0, model.bias])          # [from, to] through a token without features
        self.move, powers = t, [np.eye(2)]
        for _ in range(POWERS):
            p = powers[-1] @ plain
            powers.append(p / p.max())
        self.powers = np.array(powers)

    def marginals(self, token: np.ndarray, index: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """(featured tokens, probability that each is toxic)."""
        if not len(token):
            return token, np.zeros(0)
        at, start = np.unique(token, return_index=True)
        emit = np.exp(np.clip(self.model.bias + np.add.reduceat(self.model.weights[index], start), -50, 50))
        gap = np.minimum(np.diff(at) - 1, POWERS)
        first = int(at[0])
        # before the first word any state is open: its own emission only
        a = np.array([1.0, 1.0])
        if first:
            a = np.array([1.0, np.exp(self.model.bias)]) @ self.powers[min(first - 1, POWERS)] @ self.move
        fore = []
        for k, e in enumerate(emit.tolist()):
            if k:
                a = a @ self.powers[gap[k - 1]] @ self.move
            a = a * (1.0, e)
            a = a / a.sum()
            fore.append(a)
        z = self.powers[min(n_words - int(at[-1]) - 1, POWERS)].sum(axis=1)
        back = [z]
        for k in range(len(emit) - 1, 0, -1):
            z = self.powers[gap[k - 1]] @ (self.move @ (z * (1.0, float(emit[k]))))
            z = z / z.sum()
            back.append(z)
        p = np.array(fore) * np.array(back[::-1])
        return at, p[:, 1] / p.sum(axis=1)

    @staticmethod
    def evidence(at: np.ndarray, p: np.ndarray) -> float:
        """Expected log odds against "no token is toxic" over the featured tokens."""
        return float(-np.log1p(-np.minimum(p, 1 - 1e-9)).sum())

    def score(self, evidence: float) -> float:
        return 1 / (1 + np.exp(-np.clip(self.model.slope * np.log(evidence + 1e-6) + self.model.offset, -30, 30)))


def score_toxicity(docs: DataFrame, model: ToxicityModel, *keep: Column, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id``, ``keep``, ``score`` (0 to 1) and ``spans`` (byte start and length in UTF-8 of words
    with a marginal of at least one half), one row per input row.

    Null and empty texts have no tokens and get the score of a text without evidence; ids may
    repeat or be null; equal texts get equal scores; an empty table gives an empty table;
    other columns are read only when kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("_text"))
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())])
    out_type = T.StructType([f for f in d.schema.fields if f.name != "_text"] + [
        T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    schema = to_arrow_schema(out_type)

    def run(batches):
        m = shared.value
        chain, table = Chain(m), m.table()
        nothing = chain.score(0.0)
        for batch in slices(batches, "_text"):
            b = Batch(batch.column("_text"), WORD_BYTES, lower=True)
            score, spans = np.full(b.n, nothing), [[]] * b.n
            token, index = find_features(b, m.features, table)
            at = np.searchsorted(token, b.first)
            for i in np.flatnonzero(np.diff(at)).tolist():
                f = b.first[i]
                t, p = chain.marginals(token[at[i]:at[i + 1]] - f, index[at[i]:at[i + 1]], int(b.first[i + 1] - f))
                score[i] = chain.score(chain.evidence(t, p))
                spans[i] = [{"start": int(b.starts[w] - b.off[i]), "length": int(b.ends[w] - b.starts[w])}
                            for w in (t[p >= 0.5] + f).tolist()]
            kept = [batch.column(k) for k, c in enumerate(batch.schema) if c.name != "_text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score), pa.array(spans, schema.field("spans").type)], schema=schema)

    return d.mapInArrow(run, out_type)
