"""Benchmark decontamination with a generalised suffix automaton over the test items' words.

The automaton holds every run of words of every item.  A document's words are streamed
through it; the longest match ending at each word tells which words lie in a window of an
item, and the state names the items.  Only stretches whose neighbouring word pairs all
occur in items can hold a match of two words or more, so the stream starts anew at each
stretch (at a pair that no item has, the longest match is at most one word).

Items are taken in blocks of bounded size, each a broadcast automaton, and the documents
pass all blocks in one scan without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewell.llm.textops import ALNUM_WORDS, Batch, slices

WINDOW = 10
BLOCK_BYTES = 1 << 20        # item text in one automaton


class Automaton:
    """Generalised suffix automaton of items (id, words as integers)."""

    def __init__(self, ids: list[str], items: list[list[int]], window: int):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.ids, self.window = ids, window
        # short items, by the state of their whole sequence
        self.whole: dict[int, list[int]] = {}
        for i, words in enumerate(items):
            last = 0
            for w in words:
                last = self._add(last, w)
            if words and len(words) < window:
                self.whole.setdefault(last, []).append(i)
        # items with the window that a state stands for: states whose lengths span the window length
        self.items: dict[int, set[int]] = {}
        seen = [-1] * len(self.len)
        for i, words in enumerate(items):
            v = 0
            for w in words:
                u = v = self.next[v][w]
                while u > 0 and seen[u] != i:
                    seen[u] = i
                    if self.len[self.link[u]] < window <= self.len[u]:
                        self.items.setdefault(u, set()).add(i)
                    u = self.link[u]
        # nearest suffix state, itself included, that is a whole short item
        self.short = [-1] * len(self.len)
        for u in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            self.short[u] = u if u in self.whole else self.short[self.link[u]]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.len.append(length)
        self.link.append(link)
        self.next.append(moves)
        return len(self.len) - 1

    def _split(self, p: int, w: int) -> int:
        """The state of p's longest string plus w, cut off from a longer one if need be."""
        q = self.next[p][w]
        if self.len[q] == self.len[p] + 1:
            return q
        clone = self._state(self.len[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _add(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w)
        cur, p = self._state(self.len[last] + 1, 0, {}), last
        while p != -1 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        self.link[cur] = 0 if p == -1 else self._split(p, w)
        return cur

    def stream(self, words: list[int], hit: np.ndarray, found: set[int]) -> None:
        """Mark the words of one stretch that lie in a window; collect the items."""
        v = length = 0
        for i, w in enumerate(words):
            while v and w not in self.next[v]:
                v = self.link[v]
                length = self.len[v]
            if w not in self.next[v]:
                continue
            v = self.next[v][w]
            length += 1
            if length >= self.window:
                hit[i - length + 1:i + 1] = True
                u = v
                while self.len[self.link[u]] >= self.window:
                    u = self.link[u]
                found |= self.items[u]
            u = self.short[v]
            while u > 0:
                if self.len[u] <= length:
                    hit[i - self.len[u] + 1:i + 1] = True
                    found.update(self.whole[u])
                u = self.short[self.link[u]]


class Block:
    """An automaton with the vocabulary and the neighbouring word pairs of its items."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        b = Batch(pa.array(texts, pa.string()), ALNUM_WORDS, lower=True)
        h = b.hashes()
        self.vocabulary, word = np.unique(h, return_inverse=True)
        items = [word[a:z].tolist() for a, z in zip(b.first, b.first[1:])]
        size = len(self.vocabulary) + 1
        inner = np.ones(len(word), bool)
        inner[b.first[:-1][b.n_words > 0]] = False
        at = np.flatnonzero(inner)
        self.pairs = np.unique(word[at - 1] * size + word[at]) if len(at) else np.zeros(0, np.int64)
        self.shortest = min([window, *[len(x) for x in items if x]])
        self.automaton = Automaton(ids, items, window)

    def match(self, b: Batch, h: np.ndarray) -> tuple[np.ndarray, dict[int, set[int]]]:
        """(whether each word is hit, items of each text that has any)."""
        hit, items = np.zeros(len(h), bool), {}
        if not len(self.vocabulary) or not len(h):
            return hit, items
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == h
        pair = at[:-1] * (len(self.vocabulary) + 1) + at[1:]
        joined = np.zeros(len(h), bool)     # joined to the word before
        joined[1:] = known[:-1] & known[1:] & np.isin(pair, self.pairs)
        joined[b.first[:-1][b.n_words > 0]] = False
        starts = np.flatnonzero(known & ~joined)
        ends = np.flatnonzero(known & ~np.r_[joined[1:], False]) + 1
        long = ends - starts >= self.shortest
        docs = np.searchsorted(b.first, starts[long], "right") - 1
        for d, a, z in zip(docs.tolist(), starts[long].tolist(), ends[long].tolist()):
            found: set[int] = set()
            self.automaton.stream(at[a:z].tolist(), hit[a:z], found)
            if found:
                items.setdefault(d, set()).update(found)
        return hit, items


def find_contamination(docs: DataFrame, items: DataFrame, *keep: Column, id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       min_span: int = 1, max_coverage: float = 0.8) -> DataFrame:
    """Words of documents inside windows of test items.

    Words are runs of ASCII letters and digits and non-ASCII characters, A-Z lower-cased.  A
    window is ``window`` consecutive words of an item, or a shorter item as a whole.
    Result, one row per input row: ``doc_id``, ``keep``, ``n_words``, ``n_hit``, ``item_ids``
    (sorted strings), ``clean_text`` (without the hit runs of at least ``min_span`` words)
    and ``exceeds`` (hit words are more than ``max_coverage`` of the text).

    Defined cases: null and empty texts have no words, and their ``clean_text`` is the text;
    items without words match nothing; a null item id counts as the empty string, equal
    ids as one item; ids of documents may repeat or be null; empty tables give no hits or no
    rows; other columns are read only when kept, whatever their names.
    """
    spark = docs.sparkSession
    items = items.select(F.coalesce(F.col(item_id_col).cast("string"), F.lit("")).alias("id"), F.col(item_text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    d = docs.select(F.struct(F.col(id_col).alias("doc_id"), *keep).alias("kept"), F.col(text_col).alias("_text"))
    shared = []
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        rows = part.dropDuplicates().collect()
        if rows:
            shared.append(spark.sparkContext.broadcast(Block([r["id"] for r in rows], [r["text"] for r in rows], window)))
    out_type = T.StructType([
        d.schema["kept"], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())), T.StructField("clean_text", T.StringType()),
        T.StructField("exceeds", T.BooleanType())])
    out = d.mapInArrow(_cut(shared, to_arrow_schema(out_type), min_span, max_coverage), out_type)
    return out.select("kept.*", *out_type.names[1:])


def _match(shared: list, b: Batch) -> tuple[np.ndarray, dict[int, set[str]]]:
    """(whether each word is hit in any block, ids of the items of each text that has any)."""
    hit, ids = np.zeros(len(b.starts), bool), {}
    h = b.hashes() if shared else None
    for one in shared:
        block = one.value
        more, items = block.match(b, h)
        hit |= more
        for i, found in items.items():
            ids.setdefault(i, set()).update(block.automaton.ids[x] for x in found)
    return hit, ids


def _cut(shared: list, schema: pa.Schema, min_span: int, max_coverage: float):
    """Counts, items and the texts without their hit runs: one pass, one Python worker a task, for all blocks."""
    def run(batches):
        for batch in slices(batches, "_text"):
            b = Batch(batch.column("_text"), ALNUM_WORDS, lower=True)
            hit, ids = _match(shared, b)
            n_words = b.n_words
            n_hit = np.diff(np.r_[0, np.cumsum(hit)][b.first])
            text = batch.column("_text")
            some = np.flatnonzero(n_hit)
            if len(some):
                text = text.to_pylist()
                for i in some.tolist():
                    edge = np.flatnonzero(np.diff(np.r_[0, hit[b.first[i]:b.first[i + 1]].astype(np.int8), 0])) + b.first[i]
                    raw, at, out = text[i].encode(), 0, []
                    for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
                        if e - s >= min_span:
                            out.append(raw[at:b.starts[s] - b.off[i]])
                            at = b.ends[e - 1] - b.off[i]
                    text[i] = b"".join([*out, raw[at:]]).decode()
                text = pa.array(text, pa.string())
            items = pa.array([sorted(ids.get(i, ())) for i in range(batch.num_rows)], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(n_words.astype(np.int64)), pa.array(n_hit.astype(np.int64)), items,
                 text.cast(pa.string()), pa.array(n_hit > max_coverage * n_words)], schema=schema)
    return run
