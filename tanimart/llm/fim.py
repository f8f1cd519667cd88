"""Fill-in-middle transformation with cuts from a wavelet matrix.

A text is cut at token ends, where a token is a word with the white space
before it, or white space at the text's end.  Every code point has a class:
space, line or tab character, inside a word, last of a word, white space that
ends the text.  The classes of a slice of texts are one wavelet matrix: a bit
vector per class bit, each with a rank directory, the code points stably
dealt by every bit.  The ranks of the two classes that end a token add up to
the number of tokens before any place; bisection on them finds the place of
the i-th token's end, for all cuts of a slice together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk

#: Sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Classes of code points.
SPACE, BREAK, INSIDE, LAST, TAIL = range(5)
CLASS_BITS = 3


class WaveletMatrix:
    """Rank queries over a sequence of small symbols."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.levels = len(symbols), []
        for bit in reversed(range(bits)):
            one = (symbols >> bit) & 1 == 1
            padded = np.zeros(-(-(self.n + 1) // 64) * 64, dtype=bool)
            padded[:self.n] = one
            words = np.packbits(padded, bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((bit, words, before, self.n - int(one.sum())))
            symbols = np.concatenate([symbols[~one], symbols[one]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[at >> 6] + np.bitwise_count(words[at >> 6] & below)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before each place."""
        first, last = np.zeros(1, dtype=np.int64), at.astype(np.int64)
        for bit, words, before, zeros in self.levels:
            a, b = self._ones(words, before, first), self._ones(words, before, last)
            first, last = (zeros + a, zeros + b) if symbol >> bit & 1 else (first - a, last - b)
        return last - first


def classes(lead: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of every code point from its first byte; ``ends`` are the texts' ends."""
    out = np.full(len(lead), INSIDE, dtype=np.uint8)
    if not len(lead):
        return out
    gap = tk.IS_SPACE[lead]
    out[gap] = np.where(lead[gap] == 0x20, SPACE, BREAK)
    end = np.zeros(len(lead) + 1, dtype=bool)
    end[ends] = True
    end = end[1:]
    follows = np.append(gap[1:], True) | end
    out[~gap & follows] = LAST
    out[gap & end] = TAIL
    return out


def cuts(matrix: WaveletMatrix, start: np.ndarray, end: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Least place in each start .. end with so many token ends between."""
    ended = lambda at: matrix.rank(LAST, at) + matrix.rank(TAIL, at)
    want, lo, hi = ended(start) + tokens, start.copy(), end.copy()
    while (lo < hi).any():
        mid = (lo + hi) >> 1
        enough = ended(mid) >= want
        lo, hi = np.where(enough, lo, mid + 1), np.where(enough, mid, hi)
        lo = np.minimum(lo, hi)
    return lo


def restored(text: str, form: str):
    """Column: the text that an output of this form was made from."""
    part = F.split(F.col(text), "<[PSM]>", -1)
    return (F.when(F.col(form) == "psm", F.concat(part[1], part[3], part[2]))
            .when(F.col(form) == "spm", F.concat(part[2], part[3], part[1])).otherwise(F.col(text)))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """Return (doc_id, n, form, prefix_chars, middle_chars, fim_text) per row.

    n is the number of tokens.  The hash of seed and id draws two of the n + 1
    cuts, whether the text is transformed (``percent``) and whether the suffix
    comes first (``spm_percent``: form spm, else psm).  Empty texts and texts
    that hold a sentinel stay plain, with null lengths.  A null text is empty,
    a null id hashes as the empty string.  Rows that share an id share their
    draws.  An empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    draws = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), digest.alias("digest"))
    draw = lambda k: F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long")
    held = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        held = held | F.contains(F.col("text"), F.lit(mark))
    plain = (F.col("text") == "") | held | (draw(2) % 100 >= percent)
    form = F.when(plain, "plain").when(draw(3) % 100 < spm_percent, "spm").otherwise("psm")
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            forms = batch.column(4).to_pylist()
            data, off = tk.flat(batch.column(1))
            for i, j in tk.slices(off):
                part, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
                at = np.flatnonzero((part & 0xC0) != 0x80)  # first bytes of code points
                point = np.searchsorted(at, o)
                matrix = WaveletMatrix(classes(part[at], point[1:][np.diff(point) > 0]), CLASS_BITS)
                start, end = point[:-1], point[1:]
                n = (matrix.rank(LAST, end) + matrix.rank(TAIL, end)) - (matrix.rank(LAST, start) + matrix.rank(TAIL, start))
                a, b = h1[i:j] % (n + 1), h2[i:j] % (n + 1)
                place = cuts(matrix, np.concatenate([start, start]), np.concatenate([end, end]), np.concatenate([np.minimum(a, b), np.maximum(a, b)]))
                one, two = place[:j - i], place[j - i:]
                byte = np.append(at, len(part))
                raw, out = part.tobytes(), []
                for form_, w, x, y, z in zip(forms[i:j], o[:-1].tolist(), byte[one].tolist(), byte[two].tolist(), o[1:].tolist(), strict=True):
                    if form_ == "plain":
                        out.append(raw[w:z])
                    elif form_ == "psm":
                        out.append(b"".join((p, raw[w:x], s, raw[y:z], m, raw[x:y])))
                    else:
                        out.append(b"".join((s, raw[y:z], p, raw[w:x], m, raw[x:y])))
                cut = np.array([f != "plain" for f in forms[i:j]], dtype=bool)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(n), pa.array(forms[i:j], pa.string()), pa.array(one - start, mask=~cut),
                    pa.array(two - one, mask=~cut), pa.array(out, pa.binary()).cast(pa.string())], names=kind.names)

    long = T.LongType()
    kind = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n", long), T.StructField("form", T.StringType()),
                         T.StructField("prefix_chars", long), T.StructField("middle_chars", long), T.StructField("fim_text", T.StringType())])
    return draws.select("doc_id", "text", draw(0).alias("h1"), draw(1).alias("h2"), form.alias("form")).mapInArrow(rows, kind)
