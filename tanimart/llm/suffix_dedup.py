"""Exact substring deduplication by merged Burrows-Wheeler transforms.

A byte goes if a 100-byte string that covers it also starts earlier.  Equal
texts are one class first; the first text of a class stands for it.

Windows (100-byte strings) are routed by their minimizer, the least hash of
their 32-byte substrings, so equal windows meet.  A run of windows with one
minimizer travels as one string; minimizers that occur at one place only are
left out before any text moves.  Equal strings are combined before the
shuffle, those of a minimizer with very many occurrences over all tasks.  Only
where the different strings of a minimizer are very many, its windows are
routed by their own hash instead, and those that occur at one place only are
left out in turn.

A task holds the different strings of its minimizers.  It cuts them into
shards, builds each shard's Burrows-Wheeler transform, and merges these
without sorting all suffixes again: the interleave (which shard the i-th
suffix of the merged order comes from) starts as the plain sequence of the
shards and is refined step by step; a stable distribution of the interleave
by the transforms' symbols orders the suffixes by one symbol more.  The
boundaries that appear in step d separate common prefixes of d - 1 symbols.  A
symbol is twenty bytes, so after 5 steps the blocks left are the intervals of
equal 100-byte strings (four or two bytes and more steps for lengths that are
no multiple, or where two symbols share a hash).  A string without another of
its minimizer, and without that minimizer twice, is alone in its intervals and
is not merged; of the others only the stretch is whose windows share the bytes
around their minimizer with another string.
The smallest place in a block stays, all others are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import BROADCAST_ROWS, save, settle

#: Bytes of the minimizers' substrings.
GRAM = 32
#: Occurrences that make a minimizer frequent, different strings that make its
#: windows travel alone, and how many frequent minimizers there are at most
#: (broadcast, 8 bytes each; with more the number asked for grows).
HOT = 25_000
MOST_HOT = 500_000
#: Symbols merged together, shards they are cut into, bytes of a slice.
MERGE_SYMBOLS = 1 << 17
SHARDS = 4
#: Bytes of a symbol in the merge (where the length is a multiple).
WIDE = 20
#: Ranges of a minimizer's place in its windows.
PLACES = 4
SLICE = 1 << 18
LAST = (1 << 63) - 1


def grams(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix sums, hash of the 32-byte substring at every place)."""
    sums = tk.prefix(tk.BYTE[part])
    g = sums[GRAM:] - sums[:-GRAM]
    g *= tk.powers(len(part))[1][:len(g)]
    return sums, g


def runs(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, start in the row, windows, minimizer) of the strings of a slice,
    with the prefix sums, the substrings' hashes and the slice's bytes and
    offsets."""
    lo, hi = int(off[0]), int(off[-1])
    part, off = data[lo:hi], off - lo
    n, span = len(part), length - GRAM + 1
    sums, g = grams(part)
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), sums, g, part, off
    m, s = g, 1
    while 2 * s <= span:
        m = np.minimum(m[:-s], m[s:])
        s *= 2
    if s < span:
        m = np.minimum(m[:len(m) - (span - s)], m[span - s:])
    # m[i]: minimizer of the window at i; windows that cross a row's end do not count
    edge = np.zeros(n + 1, dtype=np.int8)
    some = off[:-1] < off[1:]
    edge[np.maximum(off[:-1], off[1:] - length + 1)[some]] += 1
    edge[off[1:][some]] -= 1
    valid = np.cumsum(edge[:len(m)], dtype=np.int8) == 0
    change = np.ones(len(m) + 1, dtype=bool)
    np.not_equal(m[1:], m[:-1], out=change[1:-1])
    change[1:-1] |= valid[1:] != valid[:-1]
    start = np.flatnonzero(change[:-1] & valid)
    count = np.flatnonzero(change[1:] & valid) + 1 - start
    pieces = -(-count // span)  # more windows only where the minimizer comes again
    which = np.repeat(np.arange(len(start)), pieces)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = start[which] + nth * span
    windows = np.minimum(span, count[which] - nth * span)
    row = np.searchsorted(off, at, side="right") - 1
    # empty rows share an offset; the last of them holds the byte
    return row, at - off[row], windows, m[at], sums, g, part, off


def _cells(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(44)).astype(np.int64)


def _cell_table(h: np.ndarray) -> np.ndarray:
    """For every cell whether one of the hashes is in it."""
    table = np.zeros(1 << 20, dtype=bool)
    table[_cells(h)] = True
    return table


def repeated_inside(off: np.ndarray, row, start, windows, h, g, length: int) -> np.ndarray:
    """Strings that hold their minimizer twice, so that a window can repeat inside."""
    span = length - GRAM + 1
    if not len(h):
        return np.zeros(0, dtype=bool)
    pos = np.flatnonzero(_cell_table(h)[_cells(g)])
    values, rank = np.unique(h, return_inverse=True)
    which = np.minimum(np.searchsorted(values, g[pos]), len(values) - 1)
    same = values[which] == g[pos]
    key = np.sort((which[same] << 32) + pos[same])
    at = off[row] + start
    return np.searchsorted(key, (rank << 32) + at + windows + span - 1) - np.searchsorted(key, (rank << 32) + at) >= 2


def codes(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, bytes before the end, sizes) of the strings' suffixes, one after
    another, the empty one included; a code is the first ``width`` bytes as a
    number (only where there are so many)."""
    size = np.array([len(s) + 1 for s in strings])
    ends = np.cumsum(size) - 1
    text = np.zeros(ends[-1] + width, dtype=np.int64)
    body = np.zeros(len(text), dtype=bool)
    body[:ends[-1]] = True
    body[ends] = False
    text[body] = np.frombuffer(b"".join(strings), dtype=np.uint8)
    n = int(ends[-1]) + 1
    code = np.zeros(n, dtype=np.int64)
    for k in range(width):
        code = code * 256 + text[k:k + n]
    return code, np.repeat(ends, size) - np.arange(n), size


def alphabet(strings: list[bytes]) -> tuple[int, np.ndarray | None]:
    """Bytes per symbol, and the symbols' codes in order: four bytes where the
    strings hold no more than 65,535 different ones, else pairs as they are."""
    code, left, _ = codes(strings, 4)
    table = np.unique(code[left >= 4])
    return (4, table) if len(table) < 1 << 16 else (2, None)


def wide(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """As codes(), for symbols of more than eight bytes: equal symbols have
    one number, in the order of their hashes.  None if two different symbols
    share a hash."""
    size = np.array([len(s) + 1 for s in strings])
    ends = np.cumsum(size) - 1
    n = int(ends[-1]) + 1
    part = np.zeros(n + width, dtype=np.uint8)
    body = np.zeros(n + width, dtype=bool)
    body[:n - 1] = True
    body[ends] = False
    part[body] = np.frombuffer(b"".join(strings), dtype=np.uint8)
    left = np.repeat(ends, size) - np.arange(n)
    full = np.flatnonzero(left >= width)
    code = np.zeros(n, dtype=np.int64)
    if len(full):
        sums = tk.prefix(tk.BYTE[part])
        h = ((sums[width:n + width] - sums[:n]) * tk.powers(n + width)[1][:n])[full]
        order = np.argsort(h)
        ranked = h[order]
        change = np.ones(len(order), dtype=bool)
        np.not_equal(ranked[1:], ranked[:-1], out=change[1:])
        rank = np.cumsum(change) - 1
        code[full[order]] = rank
        words = np.ndarray((n,), dtype=np.int64, buffer=part.data, strides=(1,))
        first = full[order[change]][rank]
        for k in (*range(0, width - 8, 8), width - 8):
            if not np.array_equal(words[full[order] + k], words[first + k]):
                return None
    return code, left, size


def transform(strings: list[bytes], width: int, table: np.ndarray | None, named: tuple | None = None, depth: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, string, offset) of a shard's suffixes in order.

    A symbol is ``width`` bytes; a suffix's symbol in the transform is the one
    before it.  Suffixes of less than a symbol are the ends: they come first,
    by string and length, and no suffix is before their symbols.  ``named``
    holds the shard's symbols where they are known.  Suffixes equal in their
    first ``depth`` symbols may stay in any order: their blocks are not told
    apart before that step."""
    code, left, size = named or codes(strings, width)
    if table is not None:
        code = np.searchsorted(table, code)
    short = left < width
    rank = code + width * len(strings)
    rank[short] = np.arange(short.sum())
    step, most = 1, int(size.max())
    if depth is not None:
        most = min(most, depth * width)
    while True:
        order = np.argsort(rank)  # equal ranks are told apart by a later round
        change, ranked = np.zeros(len(order), dtype=np.int64), rank[order]
        change[1:] = ranked[1:] != ranked[:-1]
        new = np.empty_like(change)
        new[order] = np.cumsum(change)
        if new.max() == len(new) - 1 or width * step >= most:
            break
        after = np.zeros_like(new)
        ok = left >= width * step
        after[ok] = new[np.flatnonzero(ok) + width * step] + 1
        rank, step = new * (len(new) + 1) + after, 2 * step
    owner = np.repeat(np.arange(len(strings)), size)
    offset = size[owner] - 1 - left
    before = np.zeros(len(code), dtype=np.uint16 if width <= 4 else np.int64)
    before[width:] = code[:-width]
    return before[order], owner[order], offset[order]


def stable(code: np.ndarray) -> np.ndarray:
    """The stable order of the codes, sixteen bits at a time."""
    if code.dtype == np.uint16:
        return np.argsort(code, kind="stable")
    order, shift, most = np.argsort(code.astype(np.uint16), kind="stable"), 16, int(code.max(initial=0))
    while most >> shift:
        order = order[np.argsort((code >> shift).astype(np.uint16)[order], kind="stable")]
        shift += 16
    return order


def interleave(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], depth: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge transforms: (shard of every merged rank, block of every merged
    rank), blocks being the suffixes with equal first ``depth`` symbols.

    Each step orders the suffixes by one symbol more.  The rows whose suffix
    starts less than a symbol into its string have no suffix before and drop
    out; the ends take their places, each a block of its own."""
    size = [len(p[0]) for p in parts]
    n = sum(size)
    counts = [int((p[2] < width).sum()) for p in parts]
    ends = sum(counts)
    every, goes = np.concatenate([p[0] for p in parts]), np.concatenate([p[2] >= width for p in parts])
    z = np.repeat(np.arange(len(size), dtype=np.uint8), size)
    top = np.repeat(np.arange(len(size), dtype=np.uint8), counts)
    block = np.zeros(n, dtype=np.int32)
    merged, on = np.empty(n, dtype=every.dtype), np.empty(n, dtype=bool)
    new = np.empty(n, dtype=np.int32)
    new[:ends] = np.arange(ends)
    for _ in range(depth):
        at = np.concatenate([np.flatnonzero(z == k) for k in range(len(size))])
        merged[at], on[at] = every, goes
        rows = np.flatnonzero(on)
        move = rows[stable(merged[rows])]
        c, b = merged[move], block[move]
        edge = np.ones(n - ends, dtype=np.int32)
        edge[1:] = (c[1:] != c[:-1]) | (b[1:] != b[:-1])
        np.cumsum(edge, out=new[ends:])
        new[ends:] += ends - 1
        z = np.concatenate([top, z[move]])
        block = new.copy()
        if n and new[-1] == n - 1:  # all suffixes told apart
            break
    return z, block


def stretches(strings: list[bytes], groups: np.ndarray, windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, windows) of the part of every string that can repeat; none where
    it cannot.

    Equal windows hold their minimizer at the same place, so windows whose
    places are near each other share the bytes that all of these cover.  A
    group with a string that holds its minimizer twice stays as it is."""
    size = np.array([len(s) for s in strings])
    off = np.concatenate([[0], np.cumsum(size)])
    sums, g = grams(np.frombuffer(b"".join(strings), dtype=np.uint8))
    owner = np.repeat(np.arange(len(strings)), size)[:len(g)]
    pos = np.flatnonzero(g == groups[owner])
    pos = pos[pos + GRAM <= off[1:][owner[pos]]]
    at = np.zeros(len(strings), dtype=np.int64)
    at[owner[pos]] = pos
    odd = np.unique(groups[np.bincount(owner[pos], minlength=len(strings)) != 1])
    one = np.flatnonzero(~_among(groups, odd))
    p, q, w = at[one], (at - off[:-1])[one], windows[one]
    span = length - GRAM + 1
    low, high = np.full(len(one), span), np.full(len(one), -1)
    for j in range(PLACES):
        near, far = span * j // PLACES, span * (j + 1) // PLACES - 1
        a, b = np.maximum(near, q - w + 1), np.minimum(far, q)  # the string's own places
        has = np.flatnonzero(a <= b)
        key = tk.mixed(tk.spans_hash(sums, p[has] - near, p[has] - far + length) + tk.mixed(groups[one[has]]))
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        again = has[times[which] > 1]
        low[again] = np.minimum(low[again], (q - b)[again])
        high[again] = np.maximum(high[again], (q - a)[again])
    first, count = np.zeros(len(strings), dtype=np.int64), windows.astype(np.int64)
    first[one], count[one] = np.where(high < 0, 0, low), np.where(high < 0, 0, high - low + 1)
    return first, count


def repeats(strings: list[bytes], places: list[tuple[int, int, int]], windows: list[int], length: int) -> list[np.ndarray]:
    """For each string the windows (booleans) that also start at an earlier
    place; ``places`` are (id, text, start) of the strings' first occurrences."""
    shards = [list(range(k, len(strings), SHARDS)) for k in range(min(SHARDS, len(strings)))]
    by_shard = [i for own in shards for i in own]
    named = wide([strings[i] for i in by_shard], WIDE) if length % WIDE == 0 else None
    if named is not None:
        at = np.concatenate([[0], np.cumsum(named[2])])[np.cumsum([0, *map(len, shards)])]
        cut = np.cumsum([0, *map(len, shards)])
        parts = [transform([strings[i] for i in own], WIDE, None, (named[0][a:b], named[1][a:b], named[2][c:d]), length // WIDE)
                 for own, a, b, c, d in zip(shards, at[:-1], at[1:], cut[:-1], cut[1:], strict=True)]
        z, block = interleave(parts, length // WIDE, WIDE)
    else:
        width, table = alphabet(strings)
        parts = [transform([strings[i] for i in own], width, table, depth=length // width) for own in shards]
        z, block = interleave(parts, length // width, width)
    doc = {d: k for k, d in enumerate(sorted({p[:2] for p in places}))}
    rank, start = np.array([doc[p[:2]] for p in places]), np.array([p[2] for p in places])
    string, offset, found = [], [], []
    for k, (own, (_, owner, at)) in enumerate(zip(shards, parts, strict=True)):
        string.append(np.array(own)[owner])
        offset.append(at)
        found.append(block[z == k])
    string, offset, found = np.concatenate(string), np.concatenate(offset), np.concatenate(found)
    count = np.array(windows)
    own = offset < count[string]
    own[own] = np.bincount(found[own], minlength=1)[found[own]] > 1
    string, offset, found = string[own], offset[own], found[own]
    place = (rank[string].astype(np.int64) << 40) + start[string] + offset
    order = np.lexsort((place, found))
    f, p = found[order], place[order]
    head = np.ones(len(f), dtype=bool)
    head[1:] = f[1:] != f[:-1]
    least = p[head][np.cumsum(head) - 1]
    again = np.zeros(len(f), dtype=bool)
    again[order] = p > least
    base = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(base[-1], dtype=bool)
    out[base[string] + offset] = again
    return [out[base[k]:base[k + 1]] for k in range(len(strings))]


def _emit(arrays, names, kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)], names=names)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _text_key():
    return F.xxhash64("text").alias("th")


def _routed(data: np.ndarray, off: np.ndarray, length: int, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, windows, group, hash, alone, substrings' hashes, bytes,
    offsets) of the strings of a slice: runs of windows, or single windows of
    hot minimizers."""
    row, start, windows, h, sums, g, part, o = runs(data, off, length)
    alone = _among(h, hot)
    if alone.any():
        times = np.where(alone, windows, 1)
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        row, start, windows, h, alone = (np.repeat(x, times) for x in (row, start, windows, h, alone))
        start, windows = start + np.where(alone, nth, 0), np.where(alone, 1, windows)
    at = o[row] + start
    s = tk.spans_hash(sums, at, at + windows + length - 1) if len(at) else h
    return row, start, windows, np.where(alone, tk.mixed(h ^ s), h), s, alone, g, part, o


def _holding(data: np.ndarray, off: np.ndarray, table: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, bytes, offsets) of the rows of a slice that hold one of the
    hashed substrings; ``table`` is the hashes' cell table."""
    part, off = data[int(off[0]):int(off[-1])], off - off[0]
    _, g = grams(part)
    pos = np.flatnonzero(table[_cells(g)])
    pos = pos[_among(g[pos], hashes)]
    row = np.unique(np.searchsorted(off, pos, side="right") - 1)
    size = np.diff(off)[row]
    ends = np.concatenate([[0], np.cumsum(size)])
    return row, part[np.repeat(off[row] - ends[:-1], size) + np.arange(ends[-1])], ends


def _places(texts: DataFrame, length: int, hot: np.ndarray | None) -> DataFrame:
    """(h, c) of groups that occur at two or more places of different classes:
    of all minimizers, or (with ``hot``) of the single windows of those."""
    held = None if hot is None else texts.sparkSession.sparkContext.broadcast(hot)

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if held is None else _cell_table(held.value)
        for batch in batches:
            data, off = tk.flat(batch.column(1))
            th = batch.column(0).to_numpy().view(np.uint64)
            for i, j in tk.slices(off, SLICE):
                if held is None:
                    row, start, windows, h, _, g, _, o = runs(data, off[i:j + 1], length)
                    twice = repeated_inside(o, row, start, windows, h, g, length)
                else:
                    rows, own, o = _holding(data, off[i:j + 1], table, held.value)
                    row, start, _, h, _, alone, *_ = _routed(own, o, length, held.value)
                    row, start, h = rows[row[alone]], start[alone], h[alone]
                    twice = np.zeros(len(h), dtype=bool)
                loc = tk.mixed(th[i + row] + tk.mixed(start.astype(np.uint64)))
                h, loc = np.concatenate([h, h[twice]]), np.concatenate([loc, loc[twice] + np.uint64(1)])
                yield _emit([_signed(h), _signed(loc)], ["h", "loc"], [pa.int64()] * 2)

    found = texts.select("th", "text").mapInArrow(places, "h long, loc long")
    return found.groupBy("h").agg(F.min("loc").alias("a"), F.max("loc").alias("b"), F.count("*").alias("c")).where("a <> b").select("h", "c")


def _different(texts: DataFrame, length: int, often: np.ndarray) -> DataFrame:
    """(h, d): number of different strings of the frequent minimizers."""
    held = texts.sparkSession.sparkContext.broadcast(often)

    def strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _cell_table(held.value)
        for batch in batches:
            data, off = tk.flat(batch.column(0))
            for i, j in tk.slices(off, SLICE):
                _, own, o = _holding(data, off[i:j + 1], table, held.value)
                _, _, _, h, s, *_ = _routed(own, o, length, held.value[:0])
                keep = _among(h, held.value)
                yield _emit([_signed(h[keep]), _signed(s[keep])], ["h", "s"], [pa.int64()] * 2)

    return texts.select("text").mapInArrow(strings, "h long, s long").distinct().groupBy("h").agg(F.count("*").alias("d"))


def _hashes(groups: DataFrame) -> np.ndarray:
    """Sorted hashes; the caller bounds their number."""
    return np.sort(groups.select("h").toArrow().column("h").to_numpy().view(np.uint64))


def _live(texts: DataFrame, length: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(h) of the groups that can hold repeats, the minimizers whose windows
    travel alone, and all frequent ones."""
    spark = texts.sparkSession
    many = save(_places(texts, length, None), "suffix-live")
    settle(spark)
    total = many.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first().n
    least = max(HOT, total // MOST_HOT)
    often = _hashes(many.where(F.col("c") >= least))
    if not len(often):
        return many.select("h"), often, often
    wide = save(_different(texts, length, often).where(F.col("d") >= least), "suffix-wide")
    hot = _hashes(wide)
    if not len(hot):
        return many.select("h"), hot, often
    alone = save(_places(texts, length, hot), "suffix-live-windows")
    settle(spark)
    return many.join(wide, "h", "left_anti").select("h").union(alone.select("h")), hot, often


def _marks(texts: DataFrame, live: DataFrame, first: DataFrame, hot: np.ndarray, length: int) -> DataFrame:
    """(th, id, hs): each class's live groups, and its first row."""
    held = texts.sparkSession.sparkContext.broadcast(hot)

    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = tk.flat(batch.column(1))
            th = batch.column(0).to_numpy()
            for i, j in tk.slices(off, SLICE):
                row, _, _, h, *_ = _routed(data, off[i:j + 1], length, held.value)
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                once = np.ones(len(h), dtype=bool)
                once[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                yield _emit([_signed(h[once]), th[i + row[once]]], ["h", "th"], [pa.int64()] * 2)

    found = texts.select("th", "text").mapInArrow(pairs, "h long, th long").join(live, "h")
    sets = found.groupBy("th").agg(F.collect_set("h").alias("hs"))
    return save(sets.join(first.select("th", F.col("first").alias("id")), "th").select("th", "id", "hs"), "suffix-marks")


def _of(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Texts joined with the (id, th) of ``rows``; hashes of few rows are
    broadcast first, so that hardly any other texts are shuffled."""
    key = F.xxhash64("id", "th")
    if rows.count() <= BROADCAST_ROWS:
        keys = rows.select(key.alias("key"))
        texts = texts.withColumn("key", key).join(F.broadcast(keys), "key", "leftsemi").drop("key")
    return texts.join(rows, ["id", "th"])


_STRING = "h long, s long, id long, th long, start long, windows int, twice boolean, bytes binary, often boolean"


def _strings(texts: DataFrame, marks: DataFrame, hot: np.ndarray, often: np.ndarray, length: int) -> DataFrame:
    """Every occurrence of a live string; of equal ones in a slice the first
    carries the bytes."""
    held = texts.sparkSession.sparkContext.broadcast((hot, often))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "s", "id", "th", "start", "windows", "twice", "bytes", "often"]
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.bool_(), pa.binary(), pa.bool_()]
        hot, often = held.value
        for batch in batches:
            ids, ths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, off = tk.flat(batch.column(2))
            hs, n_hs = batch.column(3).flatten().to_numpy().view(np.uint64), batch.column(3).value_lengths().to_numpy()
            live = np.sort(tk.mixed(hs + tk.mixed(np.repeat(np.arange(len(n_hs)), n_hs).astype(np.uint64))))
            for i, j in tk.slices(off, SLICE):
                row, start, windows, h, s, alone, g, part, o = _routed(data, off[i:j + 1], length, hot)
                keep = _among(tk.mixed(h + tk.mixed((row + i).astype(np.uint64))), live)
                row, start, windows, h, s, alone = (x[keep] for x in (row, start, windows, h, s, alone))
                frequent = alone | _among(h, often)
                twice = repeated_inside(o, row, start, windows, h, g, length)
                order = np.lexsort((start, ths[i + row], ids[i + row], s, h))
                row, start, windows, h, s, twice, frequent = (x[order] for x in (row, start, windows, h, s, twice, frequent))
                at, size = o[row] + start, windows + length - 1
                first = np.ones(len(h), dtype=bool)
                first[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
                lens = np.where(first, size, 0)
                ends = np.concatenate([[0], np.cumsum(lens)])
                flat = part[np.repeat(at - ends[:-1], lens) + np.arange(ends[-1])]
                carried = pa.Array.from_buffers(pa.binary(), len(h), [pa.py_buffer(np.packbits(first, bitorder="little").tobytes()), pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])
                yield _emit([_signed(h), _signed(s), ids[i + row], ths[i + row], start, windows.astype(np.int32), twice, carried, frequent], names, kinds)

    both = _of(texts.select("id", "th", "text"), marks).select("id", "th", "text", "hs")
    return save(both.mapInArrow(cut, _STRING), "suffix-strings")


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _merged(strings: DataFrame, often: bool, length: int) -> DataFrame:
    """(h, s, id, th, start, again): of every different string the first place
    and the windows (packed bits) that also start earlier.  With ``often``
    there are strings of frequent minimizers: equal ones meet before the groups."""
    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["h", "s", "id", "th", "start", "again"], [pa.int64()] * 5 + [pa.binary()]
        ready: list = []  # strings of finished groups that hold two or more
        parts: list = []  # their parts that can repeat: bytes, place, first window, windows, string
        group: dict = {}
        state = {"h": None, "ready": 0, "parts": 0, "out": []}

        def close():
            if len(group) > 1 or any(v[2] for v in group.values()):
                ready.extend((state["h"], b, *v) for b, v in group.items())
                state["ready"] += sum(len(b) + 1 for b in group)
            else:
                state["out"] += [(state["h"], v[3], *v[0], b"") for v in group.values()]
            group.clear()
            if state["ready"] >= MERGE_SYMBOLS:
                narrow()

        def narrow():
            if ready:
                hs = np.array([r[0] for r in ready], dtype=np.int64).view(np.uint64)
                first, count = stretches([r[1] for r in ready], hs, np.array([r[3] for r in ready]), length)
                for r, f, n in zip(ready, first.tolist(), count.tolist(), strict=True):
                    if n:
                        (i, th, start), b = r[2], r[1][f:f + n + length - 1]
                        parts.append((b, (i, th, start + f), f, n, r))
                        state["parts"] += len(b) + 1
                    else:
                        state["out"].append((r[0], r[5], *r[2], b""))
            ready.clear()
            state["ready"] = 0
            if state["parts"] >= MERGE_SYMBOLS:
                solve()

        def solve():
            if parts:
                masks = repeats([x[0] for x in parts], [x[1] for x in parts], [x[3] for x in parts], length)
                for (_, _, f, n, r), m in zip(parts, masks, strict=True):
                    again = np.zeros(r[3], dtype=bool)
                    again[f:f + n] = m
                    state["out"].append((r[0], r[5], *r[2], np.packbits(again).tobytes() if m.any() else b""))
            parts.clear()
            state["parts"] = 0

        def drain():
            rows, state["out"] = state["out"], []
            return _emit(list(zip(*rows, strict=True)) or [[]] * 6, names, kinds)

        for batch in batches:
            for h, s, i, th, start, windows, twice, data in zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True):
                if h != state["h"]:
                    close()
                    state["h"] = h
                old = group.get(data)
                if old is None or (i, th, start) < old[0]:
                    group[data] = ((i, th, start), windows, twice, s)
            yield drain()
        close()
        narrow()
        solve()
        yield drain()

    near = strings.where("bytes IS NOT NULL")
    if often:
        same = near.where("often").groupBy("h", "s").agg(
            F.min(F.struct("id", "th", "start")).alias("p"), F.first("windows").alias("windows"),
            F.bool_or("twice").alias("twice"), F.first("bytes").alias("bytes"))
        near = near.where("NOT often").drop("often").unionByName(same.select("h", "s", "p.*", "windows", "twice", "bytes"))
    near = near.drop("often").repartition("h").sortWithinPartitions("h")
    return near.mapInArrow(merge, "h long, s long, id long, th long, start long, again binary")


def covered(at: np.ndarray, windows: np.ndarray, again: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, byte after the last) of the stretches that repeated windows
    cover: all windows of a string, or those whose bit is set in ``again``."""
    whole = again.is_null().to_numpy(zero_copy_only=False)
    masks, size = again.drop_null(), (windows[~whole] + 7) // 8
    bits = np.flatnonzero(np.unpackbits(np.frombuffer(b"".join(masks.to_pylist()), np.uint8)))
    of = np.concatenate([[0], np.cumsum(8 * size)])
    which = np.searchsorted(of, bits, side="right") - 1
    one = at[~whole][which] + bits - of[which]
    return np.concatenate([at[whole], one]), np.concatenate([at[whole] + windows[whole] + length - 1, one + length])


def _cuts(texts: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """(th, n_removed, n_spans, kept_sha256) of the classes' first texts."""
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["th", "n_removed", "n_spans", "kept_sha256"], [pa.int64()] * 3 + [pa.string()]
        for batch in batches:
            th, (data, off) = batch.column(0).to_numpy(), tk.flat(batch.column(1))
            marks, per_row = batch.column(2).flatten(), batch.column(2).value_lengths().to_numpy()
            of = np.concatenate([[0], np.cumsum(per_row)])
            for i, j in tk.slices(off, SLICE):
                own = marks.slice(of[i], of[j] - of[i])
                at = np.repeat(off[i:j] - off[i], per_row[i:j]) + own.field("start").to_numpy()
                first, last = covered(at, own.field("windows").to_numpy(), own.field("again"), length)
                part, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
                gain = np.bincount(first, minlength=len(part) + 1) - np.bincount(last, minlength=len(part) + 1)
                gone = np.cumsum(gain[:-1]) > 0
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                head = o[:-1][o[:-1] < o[1:]]
                begins[head] = gone[head]
                lost, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, begins))
                kept, ends = part[~gone].tobytes(), o - lost[o]
                sha = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield _emit([th[i:j], np.diff(lost[o]), np.diff(spans[o]), sha], names, kinds)

    lists = found.groupBy("id", "th").agg(F.collect_list(F.struct("start", "windows", "again")).alias("marks"))
    lists = save(lists, "suffix-cuts")
    out = _of(texts.select("id", "th", "text"), lists).select("th", "text", "marks").mapInArrow(cut, "th long, n_removed long, n_spans long, kept_sha256 string")
    return save(out.dropDuplicates(["th"]), "suffix-removed")


def deduplicate(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return (doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row.

    Texts are UTF-8 bytes, a null text is empty.  Order is by id (null last);
    of rows with one id the smaller text hash comes first, equal rows follow
    each other in any order.  An empty table gives no rows; other columns are
    not read.  ``length`` is a multiple of 4, at least 40.
    """
    if length < GRAM + 8 or length % 4:
        raise ValueError("length must be at least 40 and a multiple of 4")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    texts = texts.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), _text_key(), "text")
    slim = save(texts.select("doc_id", "id", "th", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "suffix-rows")
    first = save(slim.groupBy("th").agg(F.min("id").alias("first"), F.count("*").alias("c")), "suffix-classes")
    long = texts.where(F.octet_length("text") >= length)
    # rows that repeat an earlier row's text need no look at their text; where
    # they are too many to broadcast, the others are written once if they are
    # the lesser part, else all are looked at: that costs less than to move all
    # texts (equal texts are one place, and only a class's first row is cut)
    copies = save(slim.join(first.where("c > 1"), "th").where("id <> first").select("id", "th").distinct(), "suffix-copies")
    n_copies, seen = copies.count(), long
    if n_copies <= BROADCAST_ROWS:
        seen = long.join(F.broadcast(copies), ["id", "th"], "left_anti")
    elif 2 * n_copies > slim.count():
        seen = long = save(long.join(copies, ["id", "th"], "left_anti"), "suffix-texts")
        settle(spark)
    live, hot, often = _live(seen, length)
    marks = _marks(seen, live, first, hot, length)
    settle(spark)
    strings = _strings(long, marks, hot, often, length)
    settle(spark)
    merged = save(_merged(strings, len(often) > 0, length), "suffix-merged")
    settle(spark)
    firsts = merged.select("h", "s", F.col("id").alias("i"), F.col("th").alias("t"), F.col("start").alias("p"), "again")
    here = (F.col("id") == F.col("i")) & (F.col("th") == F.col("t")) & (F.col("start") == F.col("p"))
    found = (
        strings.drop("bytes", "often").join(firsts, ["h", "s"])
        .withColumn("again", F.when(here, F.col("again")))
        .where("again IS NULL OR octet_length(again) > 0")
        .select("id", "th", "start", "windows", "again")
    )
    removed = _cuts(long, found, length)
    settle(spark)
    # of a class the first row has the text's own cuts, all others go whole
    alike = slim.groupBy("doc_id", "id", "th", "n_bytes", "sha").agg(F.count("*").cast("int").alias("m")).join(first.select("th", "first"), "th").join(removed, "th", "left")
    rows = alike.withColumn("nth", F.explode(F.sequence(F.lit(1), "m")))
    copy = ((F.col("nth") > 1) | (F.col("id") != F.col("first"))) & (F.col("n_bytes") >= length)
    return rows.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
