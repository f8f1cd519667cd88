"""Benchmark decontamination by CGK embedding and bit sampling.

Texts and items are sequences of words: lower-cased runs of letters, numbers
and their marks (Unicode classes).  In scripts that put no spaces between words
(Chinese, Japanese, Thai, ...) each letter with its marks is a word.  A text is
contaminated by an item of n words if some stretch of it is within
floor(0.2 n) word edits of the item.

The CGK walk reads a sequence with one pointer: at step j it emits the word
under the pointer and moves on if bit j of the word's hash is set.  Two
sequences a few edits apart fall into step again after an edit, so edit
distance becomes Hamming distance of the emitted words.  A table samples K of
the steps; windows that agree in all of them are candidates.  Every start of
a text is a window: the sampled words of all windows come from one backward
recurrence over the steps, a vector operation per step, since a walk that
stands at position i in step j goes on the same way wherever it began.

An item is looked up through all its windows of the largest power of two
within two thirds of its length, in TABLES independent tables; candidates are
aligned with the whole item and verified by exact edit distance.  Items too
short for an edit are looked up as a whole by one key.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk

TABLES = 4
SAMPLES = 4
#: Share of an item's words that may be edited.
MOST_EDITS = 0.2
#: Items without a word are empty and match nothing.
LEAST_WORDS = 1
#: Longest window; longer items have more windows of this size.
MOST_WINDOW = 32
#: Item text bytes looked up in one pass; a larger benchmark takes several.
PASS_BYTES = 16 << 20
#: Text bytes worked on together.
SLICE = 1 << 19

_GAP = np.ones(256, dtype=bool)
_GAP[48:58] = _GAP[97:123] = _GAP[65:91] = False
#: Kinds of characters: between words, inside a word, a word of its own, and
#: going on with what stands before.
BETWEEN, INSIDE, ALONE, MARK = range(4)
#: Blocks of scripts without spaces: Thai, Lao, Myanmar, Khmer, Tai Le to New
#: Tai Lue, Tai Tham, Balinese, Japanese and Chinese, Yi, Javanese, Myanmar
#: extended, Tai Viet, Han compatibility, halfwidth kana, kana supplements, Han.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x3005, 0x3007), (0x3021, 0x312F),
    (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF))


@cache
def kinds() -> np.ndarray:
    """Kind of every code point."""
    classes = np.frombuffer("".join(unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)).encode(), np.uint8)
    out = np.zeros(len(classes), dtype=np.uint8)
    out[(classes == ord("L")) | (classes == ord("N"))] = INSIDE
    for lo, hi in UNSPACED:
        out[lo:hi + 1][classes[lo:hi + 1] == ord("L")] = ALONE
    out[0x3007] = out[0x3021:0x302A] = ALONE  # Han numerals of class N
    out[classes == ord("M")] = MARK
    out[0x200C:0x200E] = MARK  # joiners
    return out


def spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each row) of the words of rows off[i]:off[i+1]
    of the UTF-8 ``data``."""
    if not len(data) or int(data.max()) < 128:
        return tk.words(data, off, _GAP)
    at = np.flatnonzero((data & 0xC0) != 0x80)  # characters
    lead, size = data[at], np.diff(at, append=len(data))
    code = np.where(lead < 0x80, lead, lead & (0xFF >> np.minimum(size + 1, 7))).astype(np.int32)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        code[more] = code[more] << 6 | (data[at[more] + k] & 0x3F)
    kind = kinds()[code]
    rows = np.searchsorted(at, off[off < len(data)])
    edge = np.zeros(len(at), dtype=bool)
    edge[rows] = True
    kind[edge & (kind == MARK)] = BETWEEN
    # a mark is of the kind of the character it follows
    base = kind[np.maximum.accumulate(np.where(kind != MARK, np.arange(len(at)), 0))]
    first = (base != BETWEEN) & (kind != MARK)
    first[1:] &= edge[1:] | (kind[1:] == ALONE) | (base[:-1] != INSIDE)
    last = base != BETWEEN
    last[:-1] &= first[1:] | edge[1:] | (base[1:] == BETWEEN)
    start, end = at[first], (at + size)[last]
    return start, end, np.searchsorted(start, off)


def tokens(column) -> tuple[np.ndarray, np.ndarray, list]:
    """(bytes, offsets) of the lower-cased texts."""
    return tk.flat(pc.utf8_lower(column.fill_null("")))


def word_codes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit codes of the words of a slice, and each row's first word."""
    lo, hi = int(off[0]), int(off[-1])
    part, off = data[lo:hi], off - lo
    start, end, first = spans(part, off)
    if not len(start):
        return np.zeros(0, np.uint32), first
    return (tk.spans_hash(tk.prefix(tk.BYTE[part]), start, end) >> np.uint64(32)).astype(np.uint32), first


def window_words(n: int) -> int:
    return min(MOST_WINDOW, 1 << max(0, (2 * n // 3).bit_length() - 1))


class Walk:
    """One table for windows of w words."""

    def __init__(self, w: int, table: int):
        rng = np.random.default_rng([w, table, 97])
        self.steps = max(1, 3 * w // 2)
        self.sampled = set(rng.choice(self.steps, min(SAMPLES, self.steps), replace=False).tolist())
        self.factors = (rng.integers(1, 1 << 31, self.steps) * 2 + 1).astype(np.uint32)
        self.salts = (rng.integers(1, 1 << 31, self.steps // 24 + 1) * 2 + 1).astype(np.uint32)

    def keys(self, codes: np.ndarray) -> np.ndarray:
        """Sampled words' hash of the walk from every position (the last words
        are followed by a blank)."""
        n = len(codes)
        h, held, bits = np.zeros(n + 1, dtype=np.uint32), -1, None
        here, after = h[:-1], h[1:]
        moved, differ, word = np.empty(n, dtype=np.int32), np.empty(n, dtype=np.uint32), np.empty(n, dtype=np.uint32)
        for j in range(max(self.sampled), -1, -1):
            if j // 24 != held:
                held = j // 24
                bits = codes * self.salts[held]
                bits ^= bits >> np.uint32(15)
                bits *= np.uint32(0x2C1B3C6D)
                bits ^= bits >> np.uint32(13)
                bits = bits.view(np.int32)
            # h[i] becomes h[i + 1] where the pointer moves (the bit as a mask)
            np.left_shift(bits, np.int32(27 - j % 24), out=moved)
            np.right_shift(moved, np.int32(31), out=moved)
            np.bitwise_xor(here, after, out=differ)
            np.bitwise_and(differ, moved.view(np.uint32), out=differ)
            np.bitwise_xor(here, differ, out=here)
            if j in self.sampled:
                np.multiply(codes, self.factors[j], out=word)
                np.add(here, word, out=here)
        h = h[:-1]
        h ^= h >> np.uint32(16)
        return h * np.uint32(0x9E3779B1)


def whole_keys(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of n words from every position that has so many."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = codes[:m].astype(np.uint64)
    for k in range(1, n):
        h = tk.mixed(h * np.uint64(0x9E3779B97F4A7C15) + codes[k:m + k])
    return h


class Benchmark:
    """Items, their window keys per (window size, table), and the whole keys
    of items that allow no edit."""

    def __init__(self, items: list[tuple[int, str]]):
        column = pa.array([t for _, t in items], pa.string())
        codes, first = word_codes(*tokens(column))
        self.ids, self.words, self.tables = [], [], []
        for k, (item, _) in enumerate(items):
            own = codes[first[k]:first[k + 1]]
            if len(own) >= LEAST_WORDS:
                self.ids.append(item)
                self.words.append(own)
        self.length = np.array([len(x) for x in self.words], dtype=np.int64)
        self.edits = np.floor(self.length * MOST_EDITS + 1e-9).astype(np.int64)
        self.maps = np.zeros((len(self.words), 4096), dtype=bool)
        for k, own in enumerate(self.words):
            self.maps[k, own >> np.uint32(20)] = True
        self.whole = []
        for n in np.unique(self.length[self.edits == 0]).tolist():
            who = np.flatnonzero(self.length == n)
            key = np.concatenate([whole_keys(self.words[k], n) for k in who.tolist()])
            order = np.argsort(key, kind="stable")
            self.whole.append((n, key[order], who[order]))
        longer = [(k, window_words(n)) for k, n in enumerate(self.length.tolist()) if self.edits[k]]
        for w in sorted({w for _, w in longer}):
            members = [k for k, own in longer if own == w]
            for t in range(TABLES):
                walk, keys, who, where = Walk(w, t), [], [], []
                for k in members:
                    own = walk.keys(self.words[k])[: self.length[k] - w + 1]
                    keys.append(own)
                    who.append(np.full(len(own), k, dtype=np.int64))
                    where.append(np.arange(len(own)))
                key, who, where = np.concatenate(keys), np.concatenate(who), np.concatenate(where)
                order = np.argsort(key, kind="stable")
                near = np.zeros(1 << 16, dtype=bool)
                near[key >> np.uint32(16)] = True
                self.tables.append((w, walk, key[order], who[order], where[order], near))

    def hits(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item index, least edits) of every contaminated row of a slice."""
        codes, first = word_codes(data, off)
        if not len(codes) or not self.words:
            return []
        rows, items, starts = [], [], []
        row_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        ends = first[1:][row_of]
        at = np.arange(len(codes))
        for w, walk, key, who, where, near in self.tables:
            h = walk.keys(codes)
            pos = np.flatnonzero(near[h >> np.uint32(16)] & (at + w <= ends))
            lo, hi = np.searchsorted(key, h[pos], "left"), np.searchsorted(key, h[pos], "right")
            pos, lo, n = pos[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            if len(pos):
                entry = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                pos = np.repeat(pos, n)
                rows.append(row_of[pos])
                items.append(who[entry])
                starts.append(pos - where[entry])
        best: dict[tuple[int, int], int] = {}
        for n, key, who in self.whole:
            h = whole_keys(codes, n)
            pos = np.flatnonzero(np.arange(n - 1, len(codes)) < ends[:len(h)])
            lo, hi = np.searchsorted(key, h[pos], "left"), np.searchsorted(key, h[pos], "right")
            for k in range(int((hi - lo).max(initial=0))):
                on = np.flatnonzero(hi - lo > k)
                pairs = np.unique(np.stack([row_of[pos[on]], who[lo[on] + k]], 1), axis=0)
                best.update(((row, item), 0) for row, item in pairs.tolist())
        if not rows:
            return [(row, item, 0) for row, item in best]
        found = np.unique(np.stack([np.concatenate(rows), np.concatenate(items), np.concatenate(starts)], 1), axis=0)
        found = found[self._plausible(codes, first, found)]
        for row, item, start in found.tolist():  # whole copies at once
            own = self.words[item]
            if int(first[row]) <= start <= int(first[row + 1]) - len(own) and (codes[start:start + len(own)] == own).all():
                best[row, item] = 0
        for row, item, start in found.tolist():
            if best.get((row, item)) == 0:
                continue
            d = int(self.edits[item])
            a, b = max(int(first[row]), start - d), min(int(first[row + 1]), start + int(self.length[item]) + d)
            cost = least_edits(self.words[item], codes[a:b])
            if cost <= d:
                best[row, item] = min(cost, best.get((row, item), cost))
        return [(row, item, cost) for (row, item), cost in best.items()]

    def _plausible(self, codes: np.ndarray, first: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Candidates whose stretch holds n - d words of the item (by hash; no match is lost)."""
        ok = np.zeros(len(found), dtype=bool)
        for n in np.unique(self.length[found[:, 1]]).tolist():
            some = np.flatnonzero(self.length[found[:, 1]] == n)
            d = int(n * MOST_EDITS + 1e-9)
            for i in range(0, len(some), 4096):
                part = some[i:i + 4096]
                row, item, start = found[part].T
                at = start[:, None] + np.arange(-d, n + d)
                inside = (at >= first[row][:, None]) & (at < first[row + 1][:, None])
                own = codes[np.clip(at, 0, len(codes) - 1)] >> np.uint32(20)
                ok[part] = (self.maps[item[:, None], own] & inside).sum(1) >= n - d
        return ok


def least_edits(item: np.ndarray, stretch: np.ndarray) -> int:
    """Least word edits between ``item`` and any part of ``stretch``."""
    m = len(stretch)
    at = np.arange(m + 1)
    row = np.zeros(m + 1, dtype=np.int64)
    for k, word in enumerate(item, 1):
        new = np.empty(m + 1, dtype=np.int64)
        new[0] = k
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (stretch != word))
        row = np.minimum.accumulate(new - at) + at
    return int(row.min())


def _passes(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list]:
    """The items in lists of about PASS_BYTES of text."""
    items = benchmark.where(F.col(text_col).isNotNull()).select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    passes = max(1, -(-size // PASS_BYTES))
    for p in range(passes):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(passes)) == p).collect()
        yield sorted(((r.item_id, r.text) for r in part), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, edits): every text and item that match, with the least
    word edits of the aligned candidates.

    Null and empty texts and items match nothing; rows that repeat an id count
    as one text (the least edits); null ids are kept as null; empty tables give
    no rows.  The texts are scanned where they lie, once per pass of items.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = f"doc_id {docs.schema[id_col].dataType.simpleString()}, item_id long, edits int"
    out = spark.createDataFrame([], kind)
    for items in _passes(benchmark, item_col, item_text_col):
        held = spark.sparkContext.broadcast(items)

        def run(batches: Iterable[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = Benchmark(held.value)
            for batch in batches:
                data, off = tokens(batch.column(1))
                rows, who, cost = [], [], []
                for i, j in tk.slices(off, SLICE):
                    for row, item, edits in index.hits(data, off[i:j + 1]):
                        rows.append(i + row)
                        who.append(index.ids[item])
                        cost.append(edits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(who, pa.int64()), pa.array(cost, pa.int32())],
                    names=["doc_id", "item_id", "edits"])

        out = out.union(slim.mapInArrow(run, kind))
    return out.groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that no item matches."""
    at = docs.columns.index(text_col)
    for items in _passes(benchmark, item_col, item_text_col):
        held = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterable[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = Benchmark(held.value)
            for batch in batches:
                data, off = tokens(batch.column(at))
                keep = np.ones(len(off) - 1, dtype=bool)
                for i, j in tk.slices(off, SLICE):
                    for row, _, _ in index.hits(data, off[i:j + 1]):
                        keep[i + row] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
