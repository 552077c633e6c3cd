"""Periodic runs of words: stretches that repeat a period at least four times.

Short periods (up to ``DIRECT``) are found by comparing the words with themselves at each
lag.  Longer ones go by scales, each half as long again as the one before: at scale ``Q``
every window of ``Q`` starts picks its smallest hash of ``Q`` words.  Inside a run of period
``q`` (more than 2Q/3, at most Q) the windows at the run's start and one period later both lie
in the run and pick the same words, ``q`` apart, and no equal ``Q`` words lie between, as a
period's rotations differ.  So equal minimizers that follow each other at such a distance are
seeds, and each seed is extended both ways to the maximal stretch by prefix hashes.

Everything is numpy over the words of a piece of an Arrow batch; there is no shuffle.
Words and stretches are compared by 64-bit hashes.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewell.llm.textops import U64, Batch, _WORD_BASE, _powers, rolling, slices

DIRECT = 16


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = 4,
                  min_length: int = 6, loop: Column | None = None) -> DataFrame:
    """Maximal runs of words ``[^\\x20\\x09-\\x0D]+`` in each text, and the text with each run cut to one period.

    A run is a stretch whose smallest period is q and whose length is at least
    ``max(min_length, exponent * q)``, extended as far as the period holds; ``exponent`` is
    at least 4 (the seeds rely on it).  Result, one row per input row: ``doc_id``, ``n_words``,
    ``runs`` (start, length, period by start, then period; words count from 0), ``best`` (the
    longest run; ties: smallest start, then period; null without a run) and ``collapsed_text``
    (the words joined by one space, without those that some run contains after its first
    period).  ``loop``: an unsigned number per row; where 10 divides it, the text's tail is
    first made periodic (see ``looped``).

    Defined cases: a null or empty text has no words, no runs and an empty
    ``collapsed_text``; a null ``loop`` changes nothing; texts of any length are taken whole;
    rows given twice are treated alike, each for itself; null ids stay null; an empty table gives
    an empty table; other columns are not read, whatever their names.
    """
    if exponent < 4:
        raise ValueError("runs of fewer than four periods are not found by this method")
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      (F.lit(None) if loop is None else loop).cast("long").alias("loop"))
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([src.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(run)),
                           T.StructField("collapsed_text", T.StringType())])

    def find(batches):
        for piece in slices(batches, "text"):
            yield _piece(piece, exponent, min_length)

    out = src.mapInArrow(find, schema)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return out.withColumn("best", longest).withColumn("best", F.when(F.col("best").isNotNull(), F.struct(
        (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"))))


def looped(n: int, number: int) -> np.ndarray | None:
    """Which word stands at each place of a text of n words whose tail repeats by ``number``; None: unchanged."""
    if not n or number % 10:
        return None
    g = number // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _piece(piece: pa.RecordBatch, exponent: int, min_length: int) -> pa.RecordBatch:
    b = Batch(piece.column("text"))
    place = np.arange(len(b.starts))
    changed = {}
    for d, number in enumerate(piece.column("loop").to_pylist()):
        own = None if number is None else looped(int(b.n_words[d]), number)
        if own is not None:
            changed[d] = own
            place[b.first[d]:b.first[d + 1]] = b.first[d] + own
    start, length, period = find_runs(b.hashes()[place], b.first, exponent, min_length)
    edge = np.zeros(len(place) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    dropped = np.cumsum(edge)[:-1] > 0
    doc = np.searchsorted(b.first, start, "right") - 1
    bounds = np.searchsorted(doc, np.arange(b.n + 1)).astype(np.int32)
    has_runs = np.diff(bounds) > 0
    texts = []
    for d, text in enumerate(piece.column("text").to_pylist()):
        words = (text or "").encode().split()
        if d in changed:
            words = [words[i] for i in changed[d].tolist()]
        if has_runs[d]:
            words = compress(words, (~dropped[b.first[d]:b.first[d + 1]]).tolist())
        texts.append(b" ".join(words).decode())
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - b.first[doc], length, period)],
                                      ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [piece.column("doc_id"), pa.array(b.n_words.astype(np.int64)), pa.ListArray.from_arrays(pa.array(bounds), runs),
         pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "collapsed_text"])


def find_runs(words: np.ndarray, first: np.ndarray, exponent: int = 4, min_length: int = 6):
    """(start, length, period) of all runs in the texts ``words[first[d]:first[d + 1]]``, ordered."""
    found = [_short(words, first, exponent, min_length)]
    reach = DIRECT
    size, base = np.diff(first), first[:-1]
    while True:
        scale = reach * 3 // 2
        far = size >= exponent * (reach + 1)
        if not far.any():
            break
        if not far.all():       # texts too short for this scale are left out from here on
            starts = first[:-1][far]
            size, base = size[far], base[far]
            first = np.r_[0, np.cumsum(size)]
            words = words[np.repeat(starts - first[:-1], size) + np.arange(first[-1])]
        s, n, q = _scale(words, first, reach, scale, exponent, min_length)
        doc = np.searchsorted(first, s, "right") - 1
        found.append((s - first[doc] + base[doc], n, q))
        reach = scale
    start, length, period = (np.concatenate(x) for x in zip(*found))
    # a stretch that several lags give has the smallest of them as its period; the others are multiples
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])] if len(start) else np.zeros(0, bool)
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _short(words: np.ndarray, first: np.ndarray, exponent: int, min_length: int):
    """Runs with periods up to ``DIRECT``: stretches of equal words at each lag."""
    n, last = len(words), first[1:]
    inside = np.ones(n, bool)       # places whose word at the lag is in the same text
    found = []
    for lag in range(1, DIRECT + 1):
        p = last - lag
        inside[p[p >= first[:-1]]] = False
        if n <= lag:
            break
        same = np.zeros(n - lag + 2, np.int8)
        same[1:-1] = (words[lag:] == words[:-lag]) & inside[:n - lag]
        edge = np.flatnonzero(same[1:] != same[:-1])
        start, length = edge[::2], edge[1::2] - edge[::2] + lag
        keep = length >= max(min_length, exponent * lag)
        found.append((start[keep], length[keep], np.full(int(keep.sum()), lag)))
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (empty, empty, empty)


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        a = np.minimum(a[:-have], a[have:])
        have *= 2
    return np.minimum(a[:len(a) - (width - have)], a[width - have:]) if have < width else a


def _scale(words: np.ndarray, first: np.ndarray, reach: int, scale: int, exponent: int, min_length: int):
    """Runs with periods from ``reach + 1`` to ``scale``."""
    n = len(words)
    empty = np.zeros(0, np.int64)
    span = 2 * scale - 1        # words that a window of ``scale`` starts covers
    if n < span:
        return empty, empty, empty
    h = rolling(words, scale)
    low = U64((1 << int(n).bit_length()) - 1)
    least = _sliding_min((h & ~low) | np.arange(len(h), dtype=U64), scale)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first[:-1], 1)
    np.add.at(edge, np.maximum(first[1:] - span + 1, first[:-1]), -1)
    at = (least[np.cumsum(edge)[:len(least)] > 0] & low).astype(np.int64)
    at = at[np.r_[True, at[1:] != at[:-1]]] if len(at) else at
    value = h[at]
    order = np.lexsort((at, value))
    x, y = at[order[:-1]], at[order[1:]]
    doc_end = first[np.searchsorted(first, x, "right")]
    seed = (value[order[:-1]] == value[order[1:]]) & (y < doc_end) & (y - x > reach) & (y - x <= scale)
    x, y, doc_end = x[seed], y[seed], doc_end[seed]
    if not len(x):
        return empty, empty, empty
    power, inverse = _powers(_WORD_BASE, n + 1)
    total = np.r_[U64(0), np.cumsum(words * power[:n])]
    doc_start = first[np.searchsorted(first, x, "right") - 1]

    def extend(limit, right: bool):
        """Longest equal stretches after (or before) x and y, by bisection over prefix hashes."""
        lo, hi = np.zeros(len(x), np.int64), limit.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            a, c = (x, y) if right else (x - mid, y - mid)
            same = (total[a + mid] - total[a]) * inverse[a] == (total[c + mid] - total[c]) * inverse[c]
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    left = extend(x - doc_start, False)
    length = left + extend(doc_end - y, True) + (y - x)
    keep = length >= np.maximum(min_length, exponent * (y - x))
    return (x - left)[keep], length[keep], (y - x)[keep]
