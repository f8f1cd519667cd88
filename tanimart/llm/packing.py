"""Best-fit packing of token pieces with exact complements.

Texts become token ids plus an end id; a document longer than a sequence is
cut into full pieces, of which the first is what is left over.  How pieces
fill sequences depends on their lengths only, so the packing is planned on the
number of pieces of every length (at most one count per possible length).

The plan takes the longest length left and looks its gap up among the sums of
one, two and three available lengths: single lengths by availability, pair
sums in an index that is kept as lengths run out, triples as a length whose
rest is a pair sum.  A combination that fills the gap is used as often as its
counts allow.  A gap without an exact complement takes the longest piece that
fits, and what is left of it is looked up again.

Pieces then find their place by their number among the pieces of their length:
every task numbers its own, and the tasks' counts are summed up before it.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk
from .common import save

#: Text bytes tokenised together (a longer text is a slice of its own).
SLICE = 1 << 22
#: Different stretches whose ids a worker keeps; full, it starts anew.
KEPT = 600_000
#: Stretches at most so long are kept.
SHORT = 48

_held: dict = {}  # of this worker: tokenizer, model and known stretches by tokenizer text

#: Stretches that the splitting pattern leaves whole: one word of letters (ASCII,
#: Latin up to U+027F, Cyrillic up to U+047F), with the space before it.
WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc9\xd0\xd1][\x80-\xbf])+")
#: Byte-level models spell a byte as a character: visible Latin-1 as itself, the
#: others, in order, from U+0100 on.
_SEEN = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
SPELLING = {b: chr(b) for b in _SEEN} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(_SEEN)))}

#: A second random value per byte: spans are equal if two independent hashes are.
_BYTE2 = np.random.default_rng(77).integers(1, 1 << 63, 256, dtype=np.uint64)


class _Kind:
    """Classes of bytes that decide where a text can be cut for tokenising."""

    space = np.zeros(256, dtype=bool)
    space[0x20] = True
    letter = np.zeros(256, dtype=bool)
    letter[[*range(65, 91), *range(97, 123)]] = True
    visible = np.zeros(256, dtype=bool)
    visible[0x21:0x7F] = True
    digit = np.zeros(256, dtype=bool)
    digit[48:58] = True
    mark = visible & ~letter & ~digit
    #: First bytes of characters that are no white space in any script
    #: (white space outside ASCII starts with C2, E1, E2 or E3).
    starts = visible.copy()
    starts[0xC3:0xF5] = True
    starts[[0xE1, 0xE2, 0xE3]] = False
    two = np.zeros(256, dtype=bool)
    two[0xC3:0xE0] = True


def stretches(part: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Places where tokens end whatever stands around: between a visible
    character and a single space before another, around such a line feed, and
    between an ASCII letter and an ASCII mark; and the texts' starts and end.

    The pattern that splits texts before the merges joins a space only to what
    follows it, never a letter to a mark after it, and looks ahead only from
    white space, so each stretch has its own ids."""
    n = len(part)
    cut = np.zeros(n + 1, dtype=bool)
    if n > 2:
        # the character before a place is visible: ASCII, or one of two bytes
        shown = np.zeros(n + 1, dtype=bool)
        shown[1:] = _Kind.visible[part]
        shown[2:] |= _Kind.two[part[:-1]] & ((part[1:] & 0xC0) == 0x80)
        next_shown = np.append(_Kind.starts[part], False)
        gap = np.flatnonzero(_Kind.space[part] | (part == 0x0A))
        gap = gap[shown[gap] & next_shown[gap + 1]]
        cut[gap] = True
        cut[gap[part[gap] == 0x0A] + 1] = True
        cut[1:n] |= _Kind.letter[part[:-1]] & _Kind.mark[part[1:]]
    cut[off] = True
    return np.flatnonzero(cut)


def _tokenizer(text: str, specials: bool):
    key = (hash(text), specials)
    if key not in _held:
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tokenizer = Tokenizer.from_str(text)
        tokenizer.encode_special_tokens = not specials
        _held[key] = (tokenizer, tokenizer.model, {})
    return _held[key]


def encoded(part: np.ndarray, off: np.ndarray, tokenizer, model, known: dict, by_stretch: bool) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offsets) of the texts off[i]:off[i+1] of ``part``.

    ``by_stretch``: each different stretch is tokenised once, a single word by
    the merges alone; else the texts as they are."""
    raw = part.tobytes()

    def ids_of(keys: list[bytes]) -> list[bytes]:
        found = tokenizer.encode_batch([k.decode("utf-8", "replace") for k in keys], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def merged(word: bytes) -> bytes:
        return array("I", [t.id for t in model.tokenize(word.decode("latin-1").translate(SPELLING))]).tobytes()

    if not by_stretch:
        flat = ids_of([raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)])
        return np.frombuffer(b"".join(flat), np.uint32), np.concatenate([[0], np.cumsum([len(x) // 4 for x in flat])]).astype(np.int64)
    place = stretches(part, off)
    start, end = place[:-1], place[1:]
    if not len(start):
        return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
    hashes = tk.spans_hash(tk.prefix(tk.BYTE[part]), start, end)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    check = tk.spans_hash(tk.prefix(_BYTE2[part]), start, end)
    extra = np.flatnonzero(check != check[first][which])  # equal in one hash only
    which[extra] = len(first) + np.arange(len(extra))
    first = np.concatenate([first, extra])
    keys = [raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
    values = [known.get(k) for k in keys]
    missing = [i for i, v in enumerate(values) if v is None]
    words = [i for i in missing if WORD.fullmatch(keys[i])]
    others = sorted(set(missing) - set(words))
    for i in words:
        values[i] = merged(keys[i])
    for i, v in zip(others, ids_of([keys[i] for i in others]), strict=True):
        values[i] = v
    for i in missing:
        if len(keys[i]) <= SHORT:
            known[keys[i]] = values[i]
    if len(known) > KEPT:
        known.clear()
    flat, many = np.frombuffer(b"".join(values), np.uint32), np.array([len(v) // 4 for v in values], np.int64)
    base, count = np.cumsum(many) - many, many[which]
    ends = np.cumsum(count)
    ids = flat[np.repeat(base[which] - (ends - count), count) + np.arange(ends[-1])]
    return ids, np.concatenate([[0], ends])[np.searchsorted(place, off)]


_PIECE = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("part", T.IntegerType()), ("nth", T.LongType())]


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", specials: bool = False) -> DataFrame:
    """The written table (doc_id, piece, start, length, ids, part, nth).

    ``tokenizer`` is the file of a byte-level BPE tokenizer (default: the public
    byte_bpe_50k.json); tasks get its content, not the path.  ``ids`` are
    unsigned 32-bit little-endian numbers; ``start`` counts the document's ids
    before the piece; the end id is the last id of the last piece.  Strings of
    special tokens in a text are ordinary text unless ``specials``.  ``part``
    and ``nth`` number the pieces of one length within a task.

    A null text is empty (one piece, the end id alone).  Rows that share an id,
    null ids and repeated rows are documents of their own.  An empty table
    gives no pieces; other columns are not read.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    with open(tokenizer, encoding="utf-8") as f:
        content = f.read()
    held = docs.sparkSession.sparkContext.broadcast(content)  # a vocabulary, whatever the data
    spec = json.loads(content)
    split = spec.get("pre_tokenizer") or {}
    # stretches are tokenised alone only where that is known to change nothing
    by_stretch = not specials and spec.get("normalizer") is None and spec["model"].get("type", "BPE") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    kind = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType)] + [T.StructField(c, t) for c, t in _PIECE])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        worker, model, known = _tokenizer(held.value, specials)
        for batch in batches:
            data, off = tk.flat(batch.column(1))
            for i, j in tk.slices(off, SLICE):
                ids, o = encoded(data[off[i]:off[j]], off[i:j + 1] - off[i], worker, model, known, by_stretch)
                size = np.diff(o) + 1  # with the end id
                all_ids = np.empty(len(ids) + len(size), "<u4")
                last = np.cumsum(size) - 1
                body = np.ones(len(all_ids), dtype=bool)
                body[last] = False
                all_ids[body], all_ids[last] = ids, end_id
                count = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), count)
                nth_piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                head = size - (count - 1) * capacity  # the first piece takes what is left over
                begin = np.where(nth_piece == 0, 0, head[row] + (nth_piece - 1) * capacity)
                length = np.where(nth_piece == 0, head[row], capacity)
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                edge = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
                nth = np.empty_like(length)
                nth[order] = seen[ranked] + np.arange(len(ranked)) - np.repeat(edge, np.diff(np.append(edge, len(ranked))))
                np.add.at(seen, length, 1)
                # pieces follow each other in all_ids
                bounds = np.concatenate([[0], np.cumsum(4 * length)])
                blocks = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(all_ids.tobytes())])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i).take(pa.array(row)), pa.array(nth_piece.astype(np.int32)), pa.array(begin), pa.array(length),
                    blocks.cast(pa.binary()), pa.array(np.full(len(row), task, np.int32)), pa.array(nth)], names=kind.names)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return save(docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).mapInArrow(rows, kind), "pack-pieces")


class Counts:
    """Available pieces per length, with the index of their pair sums."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.n = np.zeros(capacity + 1, dtype=np.int64)
        for length, count in histogram.items():
            self.n[length] = count
        held = (self.n > 0).astype(np.int64)
        self.pairs = np.convolve(held, held)[:capacity + 1]  # ordered pairs of available lengths by sum

    def take(self, lengths: list[int], times: int) -> None:
        for length in lengths:
            self.n[length] -= times
        gone = sorted({x for x in lengths if self.n[x] == 0})
        for k, length in enumerate(gone):
            left = (self.n > 0).astype(np.int64)
            left[gone[k + 1:]] = 1  # not taken out yet
            self.pairs[length:] -= 2 * left[:len(left) - length]
            if 2 * length < len(self.pairs):
                self.pairs[2 * length] -= 1

    def times(self, lengths: list[int]) -> int:
        """How often the combination is available."""
        return min(int(self.n[x]) // lengths.count(x) for x in set(lengths))

    def pair(self, total: int, held: list[int]) -> list[int] | None:
        """Two available lengths with this sum besides ``held``, the longest first."""
        if total < 2 or not self.pairs[total]:
            return None
        a = np.arange(total - 1, (total - 1) // 2, -1)
        for x in a[(self.n[a] > 0) & (self.n[total - a] > 0)].tolist():
            if self.times([*held, x, total - x]):
                return [x, total - x]
        return None

    def complement(self, gap: int, held: list[int], most: int = 3) -> list[int] | None:
        """One, two or three (at most ``most``) available lengths that fill a gap exactly."""
        if self.n[gap] and self.times([*held, gap]):
            return [gap]
        found = self.pair(gap, held) if most > 1 else None
        if found or most < 3:
            return found
        c = np.arange(gap - 2, (gap - 1) // 3, -1)  # the longest of three
        if len(c):
            for x in c[(self.n[c] > 0) & (self.pairs[gap - c] > 0)].tolist():
                if self.times([*held, x]) and (two := self.pair(gap - x, [*held, x])):
                    return [x, *two]
        return None


    def longest(self, most: int, held: list[int]) -> int | None:
        """The longest available length up to ``most`` besides ``held``."""
        for x in np.flatnonzero(self.n[:most + 1])[::-1].tolist():
            if self.times([*held, x]):
                return x
        return None


def _filled(histogram: dict[int, int], capacity: int, most: int) -> list[tuple[int, list[int]]]:
    """Sequences started with the longest length left; a gap takes its exact
    complement of up to ``most`` lengths, else the best fit, which leaves a
    smaller gap to look up.  What one sequence holds is used as often as it is
    available, so every entry uses a length up, or all but a few of it."""
    counts, out = Counts(histogram, capacity), []
    while (top := counts.longest(capacity, [])) is not None:
        held, gap = [top], capacity - top
        while gap:
            found = counts.complement(gap, held, most)
            if found is None:
                best = counts.longest(gap, held)
                if best is None:
                    break
                found = [best]
            held += found
            gap -= sum(found)
        times = counts.times(held)
        counts.take(held, times)
        out.append((times, held))
    return out


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(sequences, lengths of each) that pack all pieces of a histogram.

    Complements of several lengths use up short pieces that others may need, so
    plans with complements of up to three, two and one lengths are made (from
    the histogram, whatever the number of pieces) and the shortest is taken."""
    return min((_filled(histogram, capacity, most) for most in (3, 2, 1)), key=lambda made: sum(t for t, _ in made))


def _runs(patterns: list[tuple[int, list[int]]], capacity: int) -> tuple[np.ndarray, ...]:
    """(key of length and first number, sequence, offset) of each run of pieces
    of a length that take the same place in consecutive sequences, by key."""
    used, rows, sequence = np.zeros(capacity + 1, dtype=np.int64), [], 0
    for times, lengths in patterns:
        at = 0
        for length in lengths:
            rows.append(((length << 48) + int(used[length]), sequence - int(used[length]), at))
            used[length] += times
            at += length
        sequence += times
    rows.sort()
    return tuple(np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 3


def pack(table: DataFrame, capacity: int = 1024) -> DataFrame:
    """``table`` (columns of ``pieces``, any of them but length, part and nth
    may be missing or others added) with ``sequence_id`` and ``offset`` in
    place of part and nth.  Sequences are numbered from 0."""
    spark = table.sparkSession
    each = save(table.groupBy("length", "part").agg(F.count("*").alias("c")), "pack-counts")
    histogram = {r.length: r.c for r in each.groupBy("length").agg(F.sum("c").alias("c")).collect()}  # a row per length
    key, sequence, place = _runs(plan(histogram, capacity), capacity)
    held = spark.sparkContext.broadcast((key, sequence, place))  # bounded by the lengths, not by the rows
    before = F.coalesce(F.sum("c").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = table.join(each.select("length", "part", before.alias("__before")), ["length", "part"])
    numbered = numbered.withColumn("__number", F.col("__before") + F.col("nth")).drop("__before", "nth", "part")
    own = [c for c in table.columns if c not in ("part", "nth")]
    kind = T.StructType([numbered.schema[c] for c in own] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, to, at = held.value
        for batch in batches:
            number = batch.column(len(own)).to_numpy(zero_copy_only=False)
            run = np.searchsorted(first, (batch.column(own.index("length")).to_numpy(zero_copy_only=False) << 48) + number, side="right") - 1
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(own))), pa.array(to[run] + number), pa.array(at[run])], names=kind.names)

    return numbered.select(*own, "__number").mapInArrow(rows, kind)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, pieces): the ids of every sequence and, by offset, the
    (offset, length, doc_id, piece) in it; a sequence has at most ``capacity``
    pieces."""
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids"))).alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return rows.select("sequence_id", joined.alias("ids"), F.transform("p", lambda x: F.struct(x["offset"], x["length"], x["doc_id"], x["piece"])).alias("pieces"))
