"""Word and window hashing over whole Arrow batches (numpy inside Spark tasks).

A batch of texts is one byte buffer plus offsets; words and windows are found
and hashed for all texts of the batch at once.  Word hashes and window hashes are
polynomials modulo 2**64 over random byte values, finished by a bit mixer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

U64 = np.uint64
_BYTE_BASE, _WORD_BASE, _WORD_BASE2 = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**64 - 1, 256, dtype=np.uint64)

# words are runs of bytes outside 0x20 and 0x09-0x0D
SPACE_WORDS = np.ones(256, bool)
SPACE_WORDS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
# words are runs of ASCII digits, lower-case ASCII letters and every byte of a non-ASCII character
ALNUM_WORDS = np.zeros(256, bool)
ALNUM_WORDS[0x30:0x3A] = ALNUM_WORDS[0x61:0x7B] = ALNUM_WORDS[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_KEPT_POWERS = 1 << 19       # more are made anew each time, so that a reused Python worker stays small


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        have = []
        for b in (base, pow(base, -1, 2**64)):
            a = np.full(max(n, _KEPT_POWERS), b, U64)
            a[0] = 1
            have.append(np.multiply.accumulate(a))
        if n <= _KEPT_POWERS:
            _POWERS[base] = tuple(have)
    return have[0][:n], have[1][:n]


class Batch:
    """Texts of an Arrow column (string or binary; null counts as empty) and their words.

    ``starts``/``ends``: byte range of each word; ``first[d]:first[d+1]``: words of text d.
    """

    def __init__(self, texts, word_bytes: np.ndarray = SPACE_WORDS, lower: bool = False):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
            if isinstance(texts, pa.ChunkedArray):
                texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_binary())
        texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
        if texts.null_count:
            texts = texts.fill_null(b"")
        n = len(texts)
        _, off, buf = texts.buffers()
        off = np.frombuffer(off, np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
        data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
        data = data[off[0]:off[-1]]
        self.n, self.off = n, off - off[0]
        self.data = LOWER[data] if lower else data
        inside = word_bytes[self.data]
        size = len(inside)
        edge = np.zeros(size + 1, bool)
        edge[self.off] = True
        before = np.empty(size, bool)
        after = np.empty(size, bool)
        if size:
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, self.off)
        self.first[-1] = len(self.starts)
        self._total = None

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.n_words)

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word."""
        return self.span_hashes(self.starts, self.ends)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges."""
        if not len(starts):
            return np.zeros(0, U64)
        power, inverse = _powers(_BYTE_BASE, len(self.data) + 1)
        if self._total is None:
            self._total = np.empty(len(self.data) + 1, U64)
            self._total[0] = 0
            np.cumsum(_BYTE_VALUES[self.data] * power[:-1], out=self._total[1:])
        return mix((self._total[ends] - self._total[starts]) * inverse[starts] + (ends - starts).astype(U64))

    def windows(self, word_hashes: np.ndarray, size: int, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(first word of every window of ``size`` words inside one text, its hash)."""
        at = window_starts(self.first, size)
        return at, rolling(word_hashes, size, second)[at]


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Positions whose ``size`` words lie in one text."""
    total = int(first[-1])
    ok = np.ones(total, bool)
    last = first[1:]
    for k in range(1, size):  # the last size-1 words of a text start no window
        p = last - k
        ok[p[p >= first[:-1]]] = False
    return np.flatnonzero(ok)


def rolling(word_hashes: np.ndarray, size: int, second: bool = False) -> np.ndarray:
    """Hash of the ``size`` words from each position (only positions with that many left)."""
    n = len(word_hashes)
    if n < size:
        return np.zeros(0, U64)
    power, inverse = _powers(_WORD_BASE2 if second else _WORD_BASE, n + 1)
    total = np.empty(n + 1, U64)
    total[0] = 0
    np.cumsum(word_hashes * power[:-1], out=total[1:])
    return mix((total[size:] - total[:-size]) * inverse[:n - size + 1])


def chunk_texts(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int, max_chunk_bytes: int,
                extra: list[Column] = ()) -> tuple[DataFrame, int]:
    """(doc_id, text, chunk) with texts dealt into chunks of about ``chunk_bytes``, and the
    total of text bytes.

    The chunk of a row is a hash of its id and text, so a retried task deals the same
    rows again.  Chunks grow with the square root of the input, which keeps the messages
    between chunks and hash buckets from becoming too small.
    """
    total = docs.agg(F.sum(F.octet_length(F.col(text_col))).alias("b")).first()["b"] or 0
    size = int(min(max(chunk_bytes, 80 * total**0.5), max_chunk_bytes))
    chunks = max(1, -(-total // size))
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(chunks)).cast("int").alias("chunk"),
                      *extra)
    return out, total


SLICE_BYTES = 1 << 19


def slices(batches, column: str, limit: int = SLICE_BYTES):
    """The batches in pieces of about ``limit`` bytes of text (a longer text is one piece), so that the
    arrays made from a piece stay small whatever the number of rows in a batch."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_binary())), 0).to_numpy(zero_copy_only=False)
        piece = (np.cumsum(size) - size) // limit
        cut = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, z in zip(cut, cut[1:]):
            if z > a:
                yield batch.slice(a, z - a)


def binary(payloads: list[bytes]) -> pa.Array:
    return pa.array(payloads, pa.binary())


def joined(column, dtype) -> np.ndarray:
    """All payloads of a binary column as one array of ``dtype``."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype)
