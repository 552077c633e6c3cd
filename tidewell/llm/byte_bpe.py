"""Byte-level BPE with sentencepiece: the model file is written directly from the vocabulary.

Every rank of the vocabulary becomes one piece: its bytes mapped one by one to printable
characters, its score the negative rank, so that sentencepiece merges in rank order.
Normalisation is the identity, no space is added or replaced, and the unknown piece is one
character that no byte maps to.  A text is cut into pre-tokens by the pattern; each
pre-token is encoded on its own; decoding maps pieces back to bytes.

The serialised model (about 1 MB for 50,000 pieces) and the pattern travel to the tasks by
broadcast; encoded units are kept in a bounded table, as words repeat.
"""

from __future__ import annotations

import base64
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MAX_VOCABULARY = 1_000_000
CACHED_UNITS = 60_000


def byte_characters() -> list[str]:
    """A distinct letter for each byte, all in one block of code points."""
    return [chr(0x4E00 + b) for b in range(256)]


def read_ranks(lines: bytes) -> list[bytes]:
    """Token bytes in rank order from lines of base64 token and rank."""
    ranks = {int(rank): base64.b64decode(token) for token, rank in (x.split() for x in lines.splitlines() if x)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"more than {MAX_VOCABULARY} tokens: too large to broadcast")
    return [ranks[i] for i in range(len(ranks))]


# ---- the model file: protocol buffer fields written by hand --------------------------------

def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value) -> bytes:
    """int and bool as varint, float as fixed32, str and bytes with their length."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(int(value) & (1 << 64) - 1)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


# field numbers and codes of the public sentencepiece_model.proto: fixed values
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE = 1, 2, 3
_UNKNOWN = 2
_MODEL_TYPE, _BPE, _VOCAB_SIZE = 3, 2, 4
_UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID, _UNK_PIECE = 40, 41, 42, 43, 45
_NAME, _ADD_DUMMY_PREFIX, _REMOVE_EXTRA, _ESCAPE = 1, 3, 4, 5


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A BPE model whose piece ids are the ranks; the id after the last rank is the unknown piece."""
    letters = byte_characters()
    pieces = [_field(_PIECE, "".join(letters[b] for b in t)) + _field(_SCORE, float(-rank)) for rank, t in enumerate(tokens)]
    pieces.append(_field(_PIECE, "⁇") + _field(_SCORE, 0.0) + _field(_TYPE, _UNKNOWN))
    trainer = (_field(_MODEL_TYPE, _BPE) + _field(_VOCAB_SIZE, len(pieces)) + _field(_UNK_ID, len(tokens))
               + _field(_BOS_ID, -1) + _field(_EOS_ID, -1) + _field(_PAD_ID, -1) + _field(_UNK_PIECE, "⁇"))
    normalizer = (_field(_NAME, "identity") + _field(_ADD_DUMMY_PREFIX, 0) + _field(_REMOVE_EXTRA, 0) + _field(_ESCAPE, 0))
    return b"".join(_field(_PIECES, p) for p in pieces) + _field(_TRAINER, trainer) + _field(_NORMALIZER, normalizer)


PIECE_BYTES = 1 << 20       # texts encoded at once

# the bytes' letters in UTF-8, three bytes each
_MAPPED = np.frombuffer("".join(byte_characters()).encode(), np.uint8).reshape(256, 3)


def _bytes(*spans) -> np.ndarray:
    out = np.zeros(256, bool)
    for first, last in spans:
        out[first:last + 1] = True
    return out


# kinds of bytes: ASCII letters; ASCII white space (with the controls that count as such); ASCII signs that are
# neither, nor digits, nor the apostrophe that may begin a contraction; first bytes of other white space
_LETTER, _WHITE = _bytes((0x41, 0x5A), (0x61, 0x7A)), _bytes((0x09, 0x0D), (0x1C, 0x20))
_SIGN = ~_LETTER & ~_WHITE & ~_bytes((0x30, 0x39), (0x27, 0x27), (0x80, 0xFF))
_MAYBE_WHITE = _bytes((0xC2, 0xC2), (0xE1, 0xE3))


def _units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the units that texts are cut into, whether a unit is letters, perhaps after one space).

    Cuts are made only where a match of the pattern ends in any case and where neither side
    matches differently for it: at each text's start; before a space that a non-space
    follows; between an ASCII or Latin-1 letter and another ASCII sign on either side (not after an
    apostrophe); before white space after an ASCII sign; after a line feed between two non-spaces.
    """
    size = len(data)
    own = np.zeros(size + 1, bool)      # where texts start or end
    own[off] = True
    letter = _LETTER[data]
    wide = np.flatnonzero(data[:-1] == 0xC3)
    wide = wide[(data[wide + 1] != 0x97) & (data[wide + 1] != 0xB7)]
    letter[wide] = letter[wide + 1] = True
    before, here = data[:-1], data[1:]
    ascii_, white = data < 0x80, _WHITE[data]
    cut = np.zeros(size + 1, bool)
    cut[1:size] = ((letter[:-1] & ascii_[1:] & ~letter[1:]) | (_SIGN[before] & letter[1:])
                   | (white[1:] & ascii_[:-1] & ~white[:-1]))
    at = np.flatnonzero(data == 0x20)
    at = at[~own[at + 1]]               # the space at a text's end has nothing after it
    cut[at[~_white_at(data, at + 1)]] = True
    feed = np.flatnonzero(data == 0x0A)
    feed = feed[~own[feed] & ~own[feed + 1]]
    feed = feed[ascii_[feed - 1] & ~white[feed - 1]]
    cut[feed[~_white_at(data, feed + 1)] + 1] = True
    cut |= own
    starts = np.flatnonzero(cut[:size])
    other = np.append(0, np.cumsum(~letter))
    ends = np.append(starts[1:], size)
    led = data[starts] == 0x20
    plain = (other[ends] - other[starts] == led) & (ends - starts > led)
    return starts, plain


def _objects(values: pa.Array) -> list:
    return values.to_numpy(zero_copy_only=False).tolist()


def _white_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the characters that begin at these bytes are white space."""
    lead = data[at]
    white = _WHITE[lead]
    some = np.flatnonzero(_MAYBE_WHITE[lead])
    if len(some):
        a, b, c = lead[some], data[at[some] + 1], data[np.minimum(at[some] + 2, len(data) - 1)]
        general = (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F)
        white[some] = ((a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80)
                       | (a == 0xE2) & general | (a == 0xE3) & (b == 0x80) & (c == 0x80))
    return white


class Codec:
    """Encoder of one process, built from the broadcast tokens and model.

    Texts are cut into units, the distinct units of a piece of a batch are looked up (or matched
    and merged), and one gather writes the ids of all texts.  With ``space_led`` a text is cut
    as ``_units`` says.  That is right for patterns like GPT-2's: matches are runs of letters, of
    digits or of signs, each perhaps after one space, contractions, and white space that leaves its
    last character to a non-space behind it; for others a text is one unit.

    ``recent`` and ``older`` hold the ids (as four bytes each) of units and pre-tokens; when the
    first is full it becomes the second, and what is still in use moves back.
    """

    def __init__(self, tokens: list[bytes], model: bytes, pattern: str, space_led: bool = False):
        import regex
        import sentencepiece
        self.whole = {t: struct.pack("=i", i) for i, t in enumerate(tokens)}
        self.tokens = pa.array(tokens, pa.large_binary())
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(pattern).findall
        self.space_led = space_led
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(byte_characters())})
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _merge(self, pre_tokens: list[bytes]) -> None:
        """Encode new pre-tokens: one that is itself in the vocabulary is one id, others go through the merges."""
        rest = []
        for p in pre_tokens:
            ids = self.whole.get(p)
            if ids is None:
                rest.append(p)
            else:
                self.recent[p] = ids
        if rest:
            self._merge_mapped(rest, [p.decode("latin-1").translate(self.letters) for p in rest])

    def _merge_mapped(self, pre_tokens: list[bytes], mapped: list[str]) -> None:
        ids = self.pieces.encode(mapped, num_threads=1)
        raw = np.fromiter(chain.from_iterable(ids), np.int32).tobytes()
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) * 4
        self.recent.update(zip(pre_tokens, map(raw.__getitem__, map(slice, [0, *ends[:-1].tolist()], ends.tolist()))))

    def _merge_plain(self, units: pa.Array) -> list[bytes]:
        """Ids of distinct units that are one pre-token each; none of them is in the vocabulary."""
        keys = _objects(units)
        out = list(map(self.recent.get, keys))
        older = self.older
        missing = []
        for i in [i for i, ids in enumerate(out) if ids is None]:
            ids = older.get(keys[i])
            if ids is None:
                missing.append(i)
            else:
                self.recent[keys[i]] = ids
        if missing:
            new = units.take(pa.array(missing))
            _, off, buf = new.buffers()
            data = _MAPPED[np.frombuffer(buf, np.uint8)]        # three bytes for each
            mapped = pa.LargeStringArray.from_buffers(len(new), pa.py_buffer(np.frombuffer(off, np.int64)[:len(new) + 1] * 3),
                                                      pa.py_buffer(data))
            self._merge_mapped([keys[i] for i in missing], _objects(mapped))
        return list(map(self.recent.__getitem__, keys)) if None in out else out

    def _known(self, key: bytes) -> bytes | None:
        ids = self.recent.get(key)
        if ids is None:
            ids = self.older.get(key)
            if ids is not None:
                self.recent[key] = ids
        return ids

    def _look_up(self, units: list[bytes]) -> list[bytes]:
        """Ids of distinct units, each cut by the pattern."""
        out = list(map(self.recent.get, units))
        if None in out:
            cut = {u: [p.encode() for p in self.find(u.decode())] for u, ids in zip(units, out) if ids is None and self._known(u) is None}
            self._merge([p for p in set(chain.from_iterable(cut.values())) if self._known(p) is None])
            for u, pre in cut.items():
                if len(pre) != 1:
                    self.recent[u] = b"".join(map(self.recent.__getitem__, pre))
            out = list(map(self.recent.__getitem__, units))
        return out

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, bounds of each text's ids); null counts as empty."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        n = len(texts)
        _, off, buf = texts.buffers()
        off = np.frombuffer(off, np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
        data = (np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8))[off[0]:off[-1]]
        off = off - off[0]
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        if self.space_led:
            starts, plain = _units(data, off)
        else:
            starts = np.unique(off[:-1][np.diff(off) > 0])
            plain = np.zeros(len(starts), bool)
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = units.dictionary_encode()
        index = coded.indices.to_numpy()
        words = coded.dictionary
        if len(self.recent) + len(words) > CACHED_UNITS:
            self.older, self.recent = self.recent, {}
        plain_word = np.zeros(len(words), bool)
        plain_word[index] = plain           # equal units are of one kind
        rank = pc.index_in(words, value_set=self.tokens)
        unknown = rank.is_null().to_numpy(zero_copy_only=False)
        length = np.ones(len(words), np.int64)
        merge, match = np.flatnonzero(plain_word & unknown), np.flatnonzero(~plain_word)
        merged = self._merge_plain(words.take(pa.array(merge))) if len(merge) else []
        matched = self._look_up(_objects(words.take(pa.array(match)))) if len(match) else []
        length[merge] = [len(x) // 4 for x in merged]
        length[match] = [len(x) // 4 for x in matched]
        bounds = np.append(0, np.cumsum(length))
        flat = np.empty(bounds[-1], np.int32)
        known = np.flatnonzero(plain_word & ~unknown)
        flat[bounds[known]] = rank.fill_null(0).to_numpy()[known]
        for which, found in ((merge, merged), (match, matched)):
            n = length[which]
            flat[np.repeat(bounds[which] - np.cumsum(n) + n, n) + np.arange(n.sum())] = np.frombuffer(b"".join(found), np.int32)
        taken = pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(flat)).take(coded.indices)
        ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:taken.offset + len(starts) + 1]
        return taken.flatten().to_numpy(), ends[np.searchsorted(starts, off)] - ends[0]

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text."""
        return self.encode_all(pa.array([text]))[0]

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """Bytes of each run ``ids[bounds[k]:bounds[k + 1]]``."""
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.tokens)):
            raise IndexError("a token id outside the vocabulary")
        taken = self.tokens.take(pa.array(ids))
        _, off, data = taken.buffers()
        off = np.frombuffer(off, np.int64)[taken.offset:taken.offset + len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        off = off[bounds]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(off.copy()), data]).cast(pa.binary())


def _pieces(size: np.ndarray, limit: int):
    """(first, last + 1) of runs of texts of about ``limit`` in sum; a larger text is one run."""
    piece = (np.cumsum(size) - size) // limit
    cut = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(size)]
    return [(a, z) for a, z in zip(cut, cut[1:]) if z > a]


_CODECS: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """One encoder for each broadcast and process."""
    if shared.id not in _CODECS:
        _CODECS.clear()
        _CODECS[shared.id] = Codec(*shared.value)
    return _CODECS[shared.id]


class _Shared:
    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id() if broadcast._jbroadcast else id(broadcast)

    @property
    def value(self):
        return self.broadcast.value

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}


class ByteBPE:
    """Column functions over one vocabulary: ``encode`` (string to ids), ``decode`` (ids to bytes) and
    ``encode_decode`` (string to both: the ids, and the bytes that they decode to, by one Python worker where the
    other two, one after the other, keep two workers with a vocabulary each).

    A null text is encoded as empty; an empty text has no ids; ids outside the vocabulary
    fail the decoding task; texts of any length are encoded whole; equal texts have equal
    ids, whatever was encoded before; an empty table stays empty.  ``space_led``: see ``Codec``.
    """

    def __init__(self, spark: SparkSession, ranks: bytes, pattern: str, space_led: bool = False):
        tokens = read_ranks(ranks)
        shared = _Shared(spark.sparkContext.broadcast((tokens, sentencepiece_model(tokens), pattern, space_led)))

        def ids_of(texts: pa.Array) -> pa.ListArray:
            codec = _codec(shared)
            size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            flat, ends = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
            for a, z in _pieces(size, PIECE_BYTES):
                ids, bounds = codec.encode_all(texts.slice(a, z - a))
                flat.append(ids)
                ends.append(bounds[1:] + ends[-1][-1])
            return pa.ListArray.from_arrays(pa.array(np.concatenate(ends).astype(np.int32)), pa.array(np.concatenate(flat)))

        def bytes_of(ids: pa.Array) -> pa.Array:
            codec = _codec(shared)
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            size = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            bounds = np.append(0, np.cumsum(size))
            out = [codec.decode_all(flat[bounds[a]:bounds[z]], bounds[a:z + 1] - bounds[a]) for a, z in _pieces(size, PIECE_BYTES // 4)]
            return pa.concat_arrays(out) if out else pa.array([], pa.binary())

        @F.arrow_udf("array<int>")
        def encode(texts: pa.Array) -> pa.Array:
            return ids_of(texts)

        @F.arrow_udf("binary")
        def decode(ids: pa.Array) -> pa.Array:
            return bytes_of(ids)

        @F.arrow_udf("struct<ids: array<int>, decoded: binary>")
        def encode_decode(texts: pa.Array) -> pa.Array:
            ids = ids_of(texts)
            return pa.StructArray.from_arrays([ids, bytes_of(ids)], ["ids", "decoded"])

        # two uses of one column of ids must not encode the texts twice
        self.encode, self.decode, self.encode_decode = encode.asNondeterministic(), decode, encode_decode.asNondeterministic()


def ranks_file(path: str) -> bytes:
    """The vocabulary file, read once by the driver (the tasks get the tokens by broadcast)."""
    with open(path, "rb") as f:
        return f.read()


def bpe_encode(docs: DataFrame, bpe: ByteBPE, text_col: str = "text", ids_col: str = "ids",
               decoded_col: str | None = None) -> DataFrame:
    """``docs`` with a column of token ids and, where ``decoded_col`` names one, the bytes that these ids decode to
    (each replacing one of the same name), one row per input row: repeated rows stay, null and empty
    texts have no ids, an empty table stays empty (see ``ByteBPE``)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    if decoded_col is None:
        return docs.withColumn(ids_col, bpe.encode(text))
    both = "_both"
    while both in (c.lower() for c in (*docs.columns, ids_col, decoded_col)):
        both += "_"
    return docs.withColumn(both, bpe.encode_decode(text)).withColumns(
        {ids_col: F.col(f"{both}.ids"), decoded_col: F.col(f"{both}.decoded")}).drop(both)


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
