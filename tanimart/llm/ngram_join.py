"""N-gram Jaccard self-join by signature trees.

Texts are sets of word shingles; two link when their Jaccard similarity is at
least num/den.  Texts with equal sets form one class, and only classes go on.

A class is routed by its prefix: the first tokens of its set in one global
order: shingles of rare words first, then by hash, and frequent shingles last.
Which words and shingles are frequent comes from a bounded sample of texts; it
decides only how many unrelated texts meet, never which pairs are found.  Two classes that link share a prefix token, so each token that two or
more classes share is a group to be joined; tokens shared by the same classes
count once.  Large groups are cut into blocks and joined block pair by block
pair.

A group's classes form a signature tree: leaves and inner nodes hold the
OR of their token bitmaps, their size range and the most tokens that share a
bit.  A dual traversal descends only into pairs of nodes whose largest
possible overlap reaches the overlap that linking needs and whose classes are
not all connected already.  Surviving pairs are verified on the full sets.

The first traversal yields each class's best partner only; the components of
the verified links then spare the second traversal all pairs inside one
component, so a group of very many copies never becomes all its pairs.  No
pair that could still connect two components is left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .common import bounded, save, settle
from .components import components

#: Expected texts in the sample that finds frequent tokens, and how many of
#: them make a token frequent.  Only the order of tokens depends on it.
SAMPLE_TEXTS = 3000
FREQUENT = 3
#: Classes of one token that one task joins with each other.
BLOCK = 1024
#: Classes of a leaf.
LEAF = 48


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a slice's words, and each row's first word."""
    lo, hi = int(off[0]), int(off[-1])
    part, off = tk.lowered(data[lo:hi]), off - lo
    start, end, first = tk.words(part, off)
    return tk.spans_hash(tk.prefix(tk.BYTE[part]), start, end) if len(start) else np.zeros(0, np.uint64), first


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int, common: Common | None = None) -> list:
    """Each row's sorted distinct shingle hashes; fewer than k words are one
    shingle, no words none.  With ``common`` each is a pair: the hashes, and
    the same tokens as integers whose order is the global one."""
    h, first = word_hashes(data, off)
    gram, row = tk.grams(h, first, k)
    cut = np.searchsorted(row, np.arange(len(first)))
    weight = None
    if common is not None and len(gram):
        sums = np.concatenate([[0], np.cumsum(common.weights(h))])
        at = np.arange(len(gram)) + first[row] - cut[row]
        weight = sums[at + k] - sums[at]
    sets: list = []
    for r, n in enumerate(np.diff(first).tolist()):
        if n >= k and common is not None:
            own, at = np.unique(gram[cut[r]:cut[r + 1]], return_index=True)
            sets.append((own, common.ordered(own, weight[cut[r] + at])))
            continue
        if n >= k:
            sets.append(np.unique(gram[cut[r]:cut[r + 1]]))
        elif n:
            whole = np.full(1, n, dtype=np.uint64)
            for x in h[first[r]:first[r + 1]]:
                whole = tk.mixed(whole * np.uint64(0x9E3779B97F4A7C15) + x)
            sets.append(whole if common is None else (whole, common.ordered(whole, np.zeros(1, np.int64))))
        else:
            none = np.zeros(0, np.uint64)
            sets.append(none if common is None else (none, np.zeros(0, np.int64)))
    return sets


def set_class(s: np.ndarray) -> int:
    """64-bit hash of a set."""
    spread = tk.mixed(s + np.uint64(0x632BE59BD9B4E019))
    both = np.array([np.bitwise_xor.reduce(spread), spread.sum(dtype=np.uint64) + np.uint64(len(s))], dtype=np.uint64)
    return int(tk.mixed(tk.mixed(both[:1]) + both[1:])[0].astype(np.int64))


class Common:
    """What a sample knows of frequency: frequent shingles, and words with
    the logarithm of their count (0 for words that it does not hold twice)."""

    def __init__(self, shingles: np.ndarray, words: np.ndarray, counts: np.ndarray):
        order = np.argsort(words)
        self.shingles, self.words = np.sort(shingles), words[order]
        self.logs = np.log2(counts[order].astype(np.float64)).astype(np.int64)

    def weights(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.logs[at], 0)

    def ordered(self, s: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Tokens as positive integers: frequent or not, weight, 54 bits of hash."""
        token = (s >> np.uint64(10)).astype(np.int64) | (np.minimum(weight, 255).astype(np.int64) << 54)
        if len(self.shingles):
            at = np.minimum(np.searchsorted(self.shingles, s), len(self.shingles) - 1)
            token |= (self.shingles[at] == s).astype(np.int64) << 62
        return np.sort(token)


def bitmap(s: np.ndarray) -> bytes:
    """The set's token bitmap: two to four bits per token, a power of two, at least 256."""
    width = max(256, 1 << (2 * len(s) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(tk.mixed(s) & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(rows: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (uint64 rows) folded to ``words`` words by OR of halves."""
    while rows.shape[1] > words:
        half = rows.shape[1] // 2
        rows = rows[:, :half] | rows[:, half:]
    return rows


class Node:
    """Classes ``at`` of a group, its children, and what bounds their overlaps."""

    def __init__(self, group: Group, at: np.ndarray):
        self.at, n = at, group.size[at]
        self.least, self.most = int(n.min()), int(n.max())
        first = group.label[at[0]]
        self.label = first if (group.label[at] == first).all() else None
        if len(at) <= LEAF:
            words = min(len(group.maps[i]) for i in at.tolist())
            self.maps = np.concatenate([folded(group.maps[i][None], words) for i in at.tolist()])
            self.children = None
            self.sizes = n
            self.union = np.bitwise_or.reduce(self.maps, axis=0)
            self.shared = int((n - np.bitwise_count(self.maps).sum(1, dtype=np.int64)).max())
        else:
            half = len(at) // 2
            self.children = [Node(group, at[:half]), Node(group, at[half:])]
            words = min(len(c.union) for c in self.children)
            self.union = np.bitwise_or.reduce(np.concatenate([folded(c.union[None], words) for c in self.children]), axis=0)
            # folding can put more tokens of a class on one bit
            self.shared = max(c.excess(words) for c in self.children)

    def excess(self, words: int) -> int:
        """Most tokens of a class beyond its bits in ``words`` words."""
        if words == len(self.union):
            return self.shared
        if self.children:
            return max(c.excess(words) for c in self.children)
        return int((self.sizes - np.bitwise_count(folded(self.maps, words)).sum(1, dtype=np.int64)).max())


class Group:
    """A token's classes and their tree."""

    def __init__(self, size, pos, label, block, maps, num: int, den: int):
        self.size, self.pos, self.label, self.block, self.maps, self.num, self.den = size, pos, label, block, maps, num, den

    def pairs(self) -> list[tuple[int, int, int]]:
        """(i, j, largest possible overlap less the needed one) of all pairs that may link."""
        order = np.lexsort((self.pos, self.size))
        out: list[tuple[int, int, int]] = []
        root = Node(self, order)
        stack = [(root, root)]
        while stack:
            x, y = stack.pop()
            if x.label is not None and x.label == y.label:
                continue
            if x.most * self.den < self.num * y.least or y.most * self.den < self.num * x.least:
                continue
            words = min(len(x.union), len(y.union))
            common = int(np.bitwise_count(folded(x.union[None], words) & folded(y.union[None], words)).sum())
            most = min(x.excess(words) + common, y.excess(words) + common, x.most, y.most)
            if most * (self.num + self.den) < self.num * (x.least + y.least):
                continue
            if x.children and (not y.children or len(x.at) >= len(y.at)):
                if x is y:
                    a, b = x.children
                    stack += [(a, a), (a, b), (b, b)]
                else:
                    stack += [(c, y) for c in x.children]
            elif y.children:
                stack += [(x, c) for c in y.children]
            else:
                self._leaves(x, y, out)
        return out

    def _leaves(self, x: Node, y: Node, out: list) -> None:
        words = min(x.maps.shape[1], y.maps.shape[1])
        a, b = folded(x.maps, words), folded(y.maps, words)
        na, nb = self.size[x.at][:, None], self.size[y.at][None, :]
        ones_a, ones_b = (np.bitwise_count(m).sum(1, dtype=np.int64) for m in (a, b))
        both = np.bitwise_count(a[:, None, :] & b[None, :, :]).sum(2, dtype=np.int64)
        most = np.minimum(na - ones_a[:, None], nb - ones_b[None, :]) + both
        slack = most * (self.num + self.den) - self.num * (na + nb)
        ok = (slack >= 0) & (self.label[x.at][:, None] != self.label[y.at][None, :])
        ok &= _can_link(na, nb, self.pos[x.at][:, None], self.pos[y.at][None, :], self.num, self.den)
        if self.block is not None:
            ok &= self.block[x.at][:, None] != self.block[y.at][None, :]
        if x is y:
            ok &= np.tri(len(x.at), k=-1, dtype=bool)
        i, j = np.nonzero(ok)
        out += zip(x.at[i].tolist(), y.at[j].tolist(), slack[i, j].tolist(), strict=True)


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).cast("string"))


def _first(id_col: str = "doc_id") -> Column:
    """Of a group's rows the smallest id (null last), then the smallest text hash."""
    return F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "th"))


def _profiles(docs: DataFrame, k: int, num: int, den: int, common: Common, id_col: str, text_col: str) -> DataFrame:
    """(tie, doc_id, th, n, cls, prefix, map) per row, written once; th is the
    text's hash."""
    held = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = tk.flat(batch.column(1))
            for i, j in tk.slices(off):
                both = shingle_sets(data, off[i:j + 1], k, held.value)
                sets = [s for s, _ in both]
                first = [t[: len(t) - -(-len(t) * num // den) + 1] if len(t) else t for _, t in both]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in first])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_class(s) if len(s) else None for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(first))),
                    pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary())], names=["doc_id", "th", "n", "cls", "prefix", "map"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), _text_hash(text_col).alias("th"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = slim.mapInArrow(run, f"doc_id {kind}, th long, n long, cls long, prefix array<long>, map binary")
    return save(out.withColumn("tie", F.monotonically_increasing_id()), "ngram-profiles")


def _common(docs: DataFrame, k: int, id_col: str, text_col: str) -> Common:
    """Frequent shingles (FREQUENT or more sampled texts hold them) and words
    (two or more occurrences) of a bounded sample of texts: at most its words
    / FREQUENT and / 2 values."""
    n = docs.count()
    share = int((1 << 30) * min(1.0, SAMPLE_TEXTS / max(1, n)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = tk.flat(batch.column(0))
            for i, j in tk.slices(off):
                own = off[i:j + 1]
                for word, h in ((False, np.concatenate(shingle_sets(data, own, k))), (True, word_hashes(data, own)[0])):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), word)), pa.array(h.astype(np.int64))], names=["word", "token"])

    sample = docs.where(F.pmod(F.xxhash64(id_col, F.lit(3)), F.lit(1 << 30)) < share).select(F.col(text_col).cast("string").alias("text"))
    counted = sample.mapInArrow(run, "word boolean, token long").groupBy("word", "token").agg(F.count("*").alias("c"))
    rows = counted.where(F.col("c") >= F.when(F.col("word"), 2).otherwise(FREQUENT)).collect()
    unsigned = lambda x: np.array(x, dtype=np.int64).astype(np.uint64)
    words = [r for r in rows if r.word]
    return Common(unsigned([r.token for r in rows if not r.word]), unsigned([r.token for r in words]), np.array([r.c for r in words], dtype=np.int64))


def _routes(classes: DataFrame, num: int, den: int) -> DataFrame:
    """(unit, block, cls, n, pos): the groups to join, large ones in block pairs.

    Two classes alone with a token meet only if their sizes, and what follows
    the token in their sets, let them link."""
    spread = classes.select("cls", "n", F.posexplode("prefix").alias("pos", "token"))
    # a token's rows are judged where they meet: most tokens have one class, and
    # a join with the shared ones would move all rows once more
    whole = Window.partitionBy("token")
    judged = spread.select("*", F.count("*").over(whole).alias("c"), F.bit_xor(F.xxhash64("cls")).over(whole).alias("x"),
                           F.min("n").over(whole).alias("a"), F.max("n").over(whole).alias("b"), F.min(F.col("n") - F.col("pos")).over(whole).alias("r"))
    shared = save(judged.where(f"c > 2 OR c = 2 AND a * {den} >= b * {num} AND r * {num + den} >= (a + b) * {num}").drop("r"), "ngram-shared")
    # of tokens with the same classes the first in the global order
    once = shared.groupBy("c", "x", "a", "b").agg(F.min("token").alias("token")).select("token", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"))
    live = shared.select("cls", "n", "pos", "token").join(once, "token")
    own = F.pmod(F.xxhash64("cls", F.lit(1)), F.col("blocks")).cast("int")
    live = live.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    part = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    return live.select("token", F.when(F.col("blocks") == 1, 0).otherwise(part).alias("part"),
                       F.when(F.col("blocks") == 1, -1).otherwise(F.when(F.col("block") == F.col("other"), -1).otherwise(F.col("block"))).alias("block"), "cls", "n", "pos")


def _can_link(na, nb, pos_a, pos_b, num: int, den: int):
    """Whether sizes, and what follows the group's token in both sets, allow a
    link.  (The token is the first that the two share, or another group has
    the pair.)"""
    most = np.minimum(na - pos_a, nb - pos_b)
    return (most * (num + den) >= num * (na + nb)) & (np.minimum(na, nb) * den >= num * np.maximum(na, nb))


def _paired(routes: DataFrame, num: int, den: int) -> DataFrame:
    """The rows of ``routes`` that have a possible partner in their group,
    before any bitmap moves."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def pick(table: pa.Table) -> pa.Table:
            key = [table.column(c).to_numpy() for c in ("token", "part")]
            n, pos, block = (table.column(c).to_numpy() for c in ("n", "pos", "block"))
            cuts = np.flatnonzero((key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])) + 1
            keep = np.zeros(len(n), dtype=bool)
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(n)], strict=True):
                own = _can_link(n[i:j, None], n[None, i:j], pos[i:j, None], pos[None, i:j], num, den)
                if block[i] >= 0:
                    own &= block[i:j, None] != block[None, i:j]
                np.fill_diagonal(own, False)
                keep[i:j] = own.any(1)
            return table.filter(pa.array(keep))

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            token, part = table.column("token").to_numpy(), table.column("part").to_numpy()
            last = int(np.flatnonzero((token != token[-1]) | (part != part[-1])).max(initial=-1)) + 1
            if last:  # the last group may go on
                yield from pick(table.slice(0, last).combine_chunks()).to_batches()
                held = table.slice(last).to_batches()
        if held:
            yield from pick(pa.Table.from_batches(held).combine_chunks()).to_batches()

    near = routes.repartition("token", "part").sortWithinPartitions("token", "part")
    return near.mapInArrow(run, routes.schema)


def _candidates(units: DataFrame, num: int, den: int, best_only: bool) -> DataFrame:
    """(token, part, a, b): the groups' pairs of classes that may link."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        key = None

        def join():
            cls, n, pos, block, label, maps = (list(x) for x in zip(*held, strict=True))
            two = block[0] >= 0
            group = Group(np.array(n), np.array(pos), np.array(label), np.array(block) if two else None,
                          [np.frombuffer(m, dtype=np.uint64) for m in maps], num, den)
            best: dict = {}
            for i, j, slack in group.pairs():
                a, b = min(cls[i], cls[j]), max(cls[i], cls[j])
                if not best_only:
                    yield a, b
                elif b not in best or (slack, -a) > best[b]:
                    best[b] = (slack, -a)
            for b, (_, a) in best.items():
                yield -a, b

        def flush():
            if len(held) > 1:
                return [(*key, *p) for p in dict.fromkeys(join())]
            return []

        def emit(rows):
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in rows], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                              names=["token", "part", "a", "b"])

        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in range(8)]
            for token, part, *row in zip(*columns, strict=True):
                if (token, part) != key:
                    out += flush()
                    held, key = [], (token, part)
                held.append(row)
            yield emit(out)
        yield emit(flush())

    near = units.select("token", "part", "cls", "n", "pos", "block", "label", "map").repartition("token", "part").sortWithinPartitions("token", "part")
    return near.mapInArrow(run, "token long, part int, a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sets reach the similarity."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                at = np.searchsorted(y, x)
                same = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(same * (num + den) >= num * (len(x) + len(y)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, profiles: DataFrame, wanted: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(cls, tokens) of the wanted classes, from one text of each: its id may
    be null or repeated, so the text's hash goes with it."""
    ids = save(profiles.select("cls", "doc_id", "th").join(wanted, "cls").groupBy("cls").agg(_first().alias("first")).select("cls", F.col("first.id").alias("own"), "first.th"), "ngram-wanted")
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"), _text_hash(text_col).alias("__th"))
    held = texts.join(bounded(ids.select("own", "th")), (F.col("__th") == F.col("th")) & F.col("__id").eqNullSafe(F.col("own")), "leftsemi")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = tk.flat(batch.column(1))
            for i, j in tk.slices(off):
                sets = [s for s in shingle_sets(data, off[i:j + 1], k) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([set_class(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "tokens"])

    found = held.mapInArrow(run, "cls long, tokens binary")
    return found.join(bounded(ids.select("cls")), "cls", "leftsemi").dropDuplicates(["cls"])


def join(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return (doc_id, n_shingles, component_id) per row.

    Words are runs of bytes other than space and TAB to CR, A-Z lower-cased.
    component_id is the smallest id reachable over links, the row's own
    included.  A null or blank text has no shingles, links with nothing and is
    its own component.  A null id never becomes a component's id (null if there
    is no other).  Rows that repeat an id are texts of their own; an empty table
    gives none; other columns are not read.
    """
    profiles = _profiles(docs, k, num, den, _common(docs, k, id_col, text_col), id_col, text_col)
    rooted = _rooted(docs, profiles, F.min("doc_id"), k, num, den, id_col, text_col)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    table = rooted.join(named, "root").select("cls", "component_id")
    return profiles.select("doc_id", "n", "cls").join(table, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _rooted(docs, profiles, least: Column, k, num, den, id_col, text_col) -> DataFrame:
    """(cls, least, root): each class with ``least`` of its rows and its component."""
    linked = _class_links(docs, profiles, k, num, den, id_col, text_col)
    member = profiles.where("cls IS NOT NULL").groupBy("cls").agg(least.alias("least"))
    roots = components(linked, "a", "b").select(F.col("node").alias("cls"), F.col("component").alias("root"))
    return save(member.join(roots, "cls", "left").select("cls", "least", F.coalesce("root", "cls").alias("root")), "ngram-roots")


def _class_links(docs, profiles, k, num, den, id_col, text_col) -> DataFrame:
    """Verified links (a, b) between classes that connect all linked classes."""
    slim = profiles.where("cls IS NOT NULL").select("tie", "cls")
    kept = slim.groupBy("cls").agg(F.min("tie").alias("tie"))
    copies = save(slim.join(kept, ["cls", "tie"], "left_anti").select("tie"), "ngram-copies")
    classes = profiles.where("cls IS NOT NULL").join(bounded(copies), "tie", "left_anti").select("cls", "n", "prefix", "map")
    routes = _routes(classes, num, den)
    routes = save(_paired(routes, num, den), "ngram-routes")
    settle(docs.sparkSession)
    units = save(routes.join(classes.select("cls", "map"), "cls"), "ngram-units")
    settle(docs.sparkSession)
    first = save(_candidates(units.withColumn("label", F.col("cls")), num, den, True), "ngram-pairs")
    tried = save(first.select("a", "b").distinct(), "ngram-tried")
    wanted = tried.select(F.col("a").alias("cls")).union(tried.select("b")).distinct()
    linked = save(_verified(tried, _sets(docs, profiles, wanted, k, id_col, text_col), num, den), "ngram-links")
    settle(docs.sparkSession)
    label = save(components(linked, "a", "b").select(F.col("node").alias("cls"), F.col("component").alias("root")), "ngram-labels")
    # a group without a candidate pair has none for other labels either
    alive = save(first.select("token", "part").distinct(), "ngram-alive")
    again = units.join(bounded(alive), ["token", "part"], "leftsemi")
    labelled = again.join(label, "cls", "left").withColumn("label", F.coalesce("root", "cls"))
    rest = save(_candidates(labelled, num, den, False).select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "ngram-pairs")
    wanted = rest.select(F.col("a").alias("cls")).union(rest.select("b")).distinct()
    more = save(_verified(rest, _sets(docs, profiles, wanted, k, id_col, text_col), num, den), "ngram-links")
    return linked.union(more)


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that stay when of each
    component one row is kept: the one with the smallest id (null last), of rows
    with that id the one with the smallest text hash, of rows equal in both any
    one.  Rows without shingles stay.

    A row is told by its id and its text's hash, so rows that share an id, or
    have none, go or stay each on its own.
    """
    profiles = _profiles(docs, k, num, den, _common(docs, k, id_col, text_col), id_col, text_col)
    rooted = _rooted(docs, profiles, _first(), k, num, den, id_col, text_col)
    stays = rooted.groupBy("root").agg(F.min("least").alias("stays"))
    table = rooted.join(stays, "root").select("cls", "stays")
    member = save(profiles.where("cls IS NOT NULL").select("doc_id", "th", "cls").join(table, "cls").select(
        F.col("doc_id").alias("__id_of"), F.col("th").alias("__text_of"), (F.col("doc_id").eqNullSafe(F.col("stays.id")) & (F.col("th") == F.col("stays.th"))).alias("stays")), "ngram-members")
    same = F.col(id_col).eqNullSafe(F.col("__id_of")) & (_text_hash(text_col) == F.col("__text_of"))
    gone = save(member.where("NOT stays").select("__id_of", "__text_of").distinct(), "ngram-gone")
    kept = docs.join(bounded(gone), same, "left_anti")
    repeated = save(member.where("stays").groupBy("__id_of", "__text_of").agg(F.count("*").alias("c")).where("c > 1").select("__id_of", "__text_of"), "ngram-again")
    if repeated.isEmpty():
        return kept
    once = kept.join(bounded(repeated), same, "leftsemi").dropDuplicates([id_col, text_col])
    return kept.join(bounded(repeated), same, "left_anti").unionByName(once)
