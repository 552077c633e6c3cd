"""Exact substring deduplication by fixed-block anchors.

Every text is cut into reference blocks of ``(window + 1) // 2`` words.  A repeat of
``window`` words holds at least one whole block of either copy, and the other copy has
the same words at some rolling position.  So:

1. Index: the hashes of all reference blocks; probe: the hash of every rolling window
   of block length.  Texts are dealt into chunks; a chunk sends each hash bucket its
   *distinct* hashes, four bytes each, with two flags (is a block here; occurs more than
   once here).  A passage in a third of all texts thus costs one entry a chunk.
2. A bucket finds the anchors, the hashes that are a block somewhere and occur at least
   twice, and tells the chunks that hold them.
3. Extension: around each anchor hit a chunk grows the windows of full length that
   contain it and sends their 64-bit hashes (a second, independent hash chooses the
   bucket).  A window whose words start anywhere else survives; overlapping survivors
   join to maximal exact repeats.

No pair of occurrences is ever listed, so the work is linear in the words whatever the
size of a group of copies.  The three passes read one exchange of the texts.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidewell.llm.textops import Batch, U64, binary, chunk_texts, joined, rolling, window_starts

CHUNK_BYTES, MAX_CHUNK_BYTES = 2 << 20, 32 << 20
BUCKET_BYTES = 16 << 20      # text bytes whose window hashes meet in one bucket

_MESSAGE = "bucket long, chunk int, n int, payload binary"


def _group_sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of each run of equal keys, run lengths) of a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return at, np.diff(np.r_[at, len(keys)])


def _messages(chunk: int, bucket: np.ndarray, residue: np.ndarray, flags: np.ndarray) -> pa.Table:
    """One row per bucket: its residues, then a byte of flags for four residues."""
    at, length = _group_sorted(bucket)
    payload = []
    for a, n in zip(at.tolist(), length.tolist()):
        bits = np.unpackbits(flags[a:a + n, None].astype(np.uint8), axis=1)[:, 6:]
        payload.append(residue[a:a + n].tobytes() + np.packbits(bits.ravel()).tobytes())
    return pa.table({"bucket": bucket[at].astype(np.int64), "chunk": np.full(len(at), chunk, np.int32),
                     "n": length.astype(np.int32), "payload": binary(payload)})


def _read_messages(table: pa.Table, dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(residues, flags, row of the message) of all messages of a bucket."""
    residue, flags = [], []
    width = np.dtype(dtype).itemsize
    n = table["n"].to_numpy()
    for k, p in zip(n.tolist(), table["payload"].to_pylist()):
        residue.append(np.frombuffer(p, dtype, k))
        bits = np.unpackbits(np.frombuffer(p, np.uint8, offset=k * width), count=2 * k).reshape(k, 2)
        flags.append(bits[:, 0] * 2 + bits[:, 1])
    return np.concatenate(residue), np.concatenate(flags), np.repeat(np.arange(len(n)), n)


def _block_windows(texts, block: int, buckets: int):
    """Batch, word hashes, positions of the block-long windows, their bucket and 32-bit residue."""
    b = Batch(texts)
    wh = b.hashes()
    at, h = b.windows(wh, block)
    bucket = (h & U64(0xFFFFFFFF)) % U64(buckets)
    return b, wh, at, (bucket << U64(32)) | (h >> U64(32))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """Remove every word covered by a window of ``window`` words that starts anywhere else too.

    Words are runs outside 0x20 and 0x09-0x0D.  Result, one row per input row: ``doc_id``,
    ``n_words``, ``n_removed``, ``kept_text`` (kept words joined by one space) and
    ``repeats`` (maximal repeats as first word and length).

    Defined cases: a null or empty text has no words and an empty ``kept_text``; a row given
    twice repeats itself, so its windows go from both; null ids stay null; an empty table
    gives an empty table; other columns are not read.
    """
    block = (window + 1) // 2
    texts, total = chunk_texts(docs, id_col, text_col, CHUNK_BYTES, MAX_CHUNK_BYTES)
    buckets = max(8, -(-total // BUCKET_BYTES))
    span = window - block       # an anchor lies at most this far into a window

    def index_and_probe(key, table):
        b, _, at, k = _block_windows(table["text"], block, buckets)
        is_block = (at - b.first[:-1][np.searchsorted(b.first, at, "right") - 1]) % block == 0 if len(at) else at == 0
        k = np.sort((k << U64(1)) | is_block.astype(U64))
        run, length = _group_sorted(k >> U64(1))
        has_block = (k[run + length - 1] & U64(1)).astype(np.uint8) if len(run) else np.zeros(0, np.uint8)
        k = k[run] >> U64(1)
        return _messages(key[0].as_py(), k >> U64(32), (k & U64(0xFFFFFFFF)).astype(np.uint32),
                         has_block * 2 + (length > 1))

    def anchors(key, table):
        residue, flags, row = _read_messages(table, np.uint32)
        order = np.argsort(residue, kind="stable")
        run, length = _group_sorted(residue[order])
        total_times = np.add.reduceat(1 + (flags[order] & 1), run)
        block_here = np.maximum.reduceat(flags[order], run) >= 2
        keep = np.empty(len(residue), bool)
        keep[order] = np.repeat((total_times > 1) & block_here, length)
        keys = (U64(key[0].as_py()) << U64(32)) | residue.astype(U64)
        return _answers(table, row, keep, keys)

    def extend(key, left, right):
        hit_keys = joined(right["payload"], np.uint64)
        empty = np.zeros(0, U64)
        if not len(hit_keys) or not left.num_rows:
            return _messages(0, empty, empty, empty)
        b, wh, at, k = _block_windows(left["text"], block, buckets)
        start, value, bucket = _candidates(b, wh, at[np.isin(k, hit_keys)], window, span, buckets)
        order = np.lexsort((value, bucket))
        value, bucket = value[order], bucket[order]
        new = np.r_[True, (value[1:] != value[:-1]) | (bucket[1:] != bucket[:-1])] if len(value) else np.zeros(0, bool)
        run = np.flatnonzero(new)
        length = np.diff(np.r_[run, len(value)])
        # key of an empty side is null: take the chunk from the texts
        return _messages(left["chunk"][0].as_py(), bucket[run], value[run], (length > 1).astype(np.uint8))

    def survivors(key, table):
        value, flags, row = _read_messages(table, np.uint64)
        order = np.argsort(value, kind="stable")
        run, length = _group_sorted(value[order])
        keep = np.empty(len(value), bool)
        keep[order] = np.repeat(np.add.reduceat(1 + (flags[order] & 1), run) > 1, length)
        return _answers(table, row, keep, value)

    def remove(key, left, right):
        if not left.num_rows:
            return out_schema_empty()
        b = Batch(left["text"])
        covered = np.zeros(len(b.starts) + 1, np.int64)
        if right.num_rows:
            wh = b.hashes()
            repeated = np.unique(joined(right["payload"], np.uint64))
            at = window_starts(b.first, window)
            value = rolling(wh, window)[at]
            at = at[np.isin(value, repeated)]
            np.add.at(covered, at, 1)
            np.add.at(covered, at + window, -1)
        gone = np.cumsum(covered)[:-1] > 0
        kept_text, repeats, removed = [], [], []
        for d, t in enumerate(left["text"].to_pylist()):
            m = gone[b.first[d]:b.first[d + 1]]
            words = (t or "").encode().split()
            n = int(m.sum())
            removed.append(n)
            kept_text.append(b" ".join(compress(words, ~m) if n else words).decode())
            edge = np.flatnonzero(np.diff(np.r_[0, m.astype(np.int8), 0])) if n else ()
            repeats.append([{"start": int(s), "length": int(e - s)} for s, e in zip(edge[::2], edge[1::2])])
        return pa.table({"doc_id": left["doc_id"], "n_words": b.n_words.astype(np.int64),
                         "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept_text, pa.string()),
                         "repeats": pa.array(repeats, repeat_type)})

    id_type = texts.schema["doc_id"].dataType
    repeat_type = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
    out_type = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_words", T.LongType()),
                             T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType()),
                             T.StructField("repeats", T.ArrayType(T.StructType([
                                 T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())])))])

    def out_schema_empty() -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        return to_arrow_schema(out_type).empty_table()

    by_chunk = texts.groupBy("chunk")
    answer = "chunk int, payload binary"
    hits = by_chunk.applyInArrow(index_and_probe, _MESSAGE).groupBy("bucket").applyInArrow(anchors, answer)
    repeated = (by_chunk.cogroup(hits.groupBy("chunk")).applyInArrow(extend, _MESSAGE)
                .groupBy("bucket").applyInArrow(survivors, answer))
    return by_chunk.cogroup(repeated.groupBy("chunk")).applyInArrow(remove, out_type)


def _answers(table: pa.Table, row: np.ndarray, keep: np.ndarray, values: np.ndarray) -> pa.Table:
    """The kept values of each message, back to the chunk that sent it."""
    row, values = row[keep], values[keep]
    at, length = _group_sorted(row)
    chunk = table["chunk"].to_numpy()[row[at]] if len(at) else np.zeros(0, np.int32)
    return pa.table({"chunk": chunk.astype(np.int32),
                     "payload": binary([values[a:a + n].tobytes() for a, n in zip(at.tolist(), length.tolist())])})


def _candidates(b: Batch, wh: np.ndarray, hits: np.ndarray, window: int, span: int, buckets: int):
    """Start, hash and bucket of the full windows that hold an anchor hit."""
    near = np.zeros(len(wh) + 1, np.int64)
    np.add.at(near, np.maximum(hits - span, 0), 1)
    np.add.at(near, hits + 1, -1)
    start = window_starts(b.first, window)
    start = start[np.cumsum(near)[:-1][start] > 0]
    value = rolling(wh, window)[start] if len(start) else np.zeros(0, U64)
    second = rolling(wh, window, second=True)[start] if len(start) else np.zeros(0, U64)
    return start, value, second % U64(buckets)
