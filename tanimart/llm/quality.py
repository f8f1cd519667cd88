"""Quality classifier: naive Bayes support vectors.

Features are hashed n-grams of words (1, 2) and of word shapes (1 to 3; a
shape is the word's run-collapsed character classes with its punctuation, and
whether it repeats the word before).  A text's indicator vector is scaled by
the class log-count ratios and brought to unit length; a linear hinge-loss
model over it is fitted by dual coordinate descent and its margin turned into
a probability by a logistic fit on rows that the model has not seen.

The fit uses a bounded sample of the labelled rows (``max_train``, drawn by a
hash of the id); scoring is one pass over all texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import save

#: Hash space of the features, and expected number of rows in the fit.
BITS = 18
MAX_TRAIN = 5000

_CLASS = np.arange(256, dtype=np.uint8)  # punctuation stands for itself
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 65, 97, 48, 97


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs, by row, for a slice of texts."""
    lo, hi = int(off[0]), int(off[-1])
    part, off = data[lo:hi], off - lo
    start, end, first = tk.words(part, off)
    n_rows = len(off) - 1
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = tk.spans_hash(tk.prefix(tk.BYTE[tk.lowered(part)]), start, end)
    kind = _CLASS[part]
    change = np.ones(len(kind), dtype=bool)
    change[1:] = kind[1:] != kind[:-1]
    change[start] = True
    at = np.zeros(len(kind) + 1, dtype=np.int64)
    np.cumsum(change, out=at[1:])
    shape = tk.spans_hash(tk.prefix(tk.BYTE[kind[change]]), at[start], at[end])
    again = np.zeros(len(word), dtype=bool)
    again[1:] = word[1:] == word[:-1]
    again[first[:-1][first[:-1] < len(word)]] = False
    shape = shape + again.astype(np.uint64)
    keys = []
    for salt, (h, k) in enumerate(((word, 1), (word, 2), (shape, 1), (shape, 2), (shape, 3))):
        g, row = tk.grams(h, first, k)
        feature = tk.mixed(g + np.uint64(salt * 0x5851F42D + 1)) >> np.uint64(64 - BITS)
        keys.append((row << BITS) | feature.astype(np.int64))
    keys = np.unique(np.concatenate(keys))
    assert not len(keys) or keys[-1] >> BITS < n_rows
    return keys >> BITS, keys & ((1 << BITS) - 1)


def _svm(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: np.ndarray, epochs: int, seed: int) -> np.ndarray:
    """Weights (last: bias) by dual coordinate descent on the hinge loss."""
    w, alpha = np.zeros(len(scale) + 1), np.zeros(len(rows))
    values = [scale[r] / max(1e-9, np.sqrt((scale[r] ** 2).sum())) for r in rows]
    size = np.array([(v * v).sum() + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            grad = y[i] * (w[rows[i]] @ values[i] + w[-1]) - 1
            new = min(max(alpha[i] - grad / size[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[rows[i]] += step * y[i] * values[i]
                w[-1] += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-5:
            break
    return w


def fit(rows: list[np.ndarray], y: np.ndarray, smooth: float = 1.0, cost: float = 1.0, epochs: int = 15, seed: int = 5) -> np.ndarray:
    """Model vector: 2**BITS weights over unit-length scaled indicators, the
    2**BITS log-count ratios, bias, and slope and offset of the logistic fit.

    With one class only the weights are zero and the score is its share; with
    no rows every score is 0.5."""
    dims, n = 1 << BITS, len(rows)
    if n == 0 or y.min() == y.max():
        share = 0.5 if n == 0 else (n * (y[0] > 0) + 1) / (n + 2)
        return np.concatenate([np.zeros(2 * dims), [0.0, 0.0, np.log(share / (1 - share))]])
    counts = [np.full(dims, smooth) for _ in range(2)]
    for r, label in zip(rows, y, strict=True):
        counts[int(label > 0)][r] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    costs = np.where(y > 0, cost * n / (2 * (y > 0).sum()), cost * n / (2 * (y < 0).sum()))
    hold = np.zeros(n, dtype=bool)
    hold[np.random.default_rng(seed).permutation(n)[: n // 5]] = True
    seen, margins = ~hold, np.zeros(n)
    if len(set(y[seen])) == 2 and len(set(y[hold])) == 2:
        w = _svm([r for r, s in zip(rows, seen, strict=True) if s], ratio, y[seen], costs[seen], epochs, seed)
        at = np.flatnonzero(hold)
    else:
        w, at = _svm(rows, ratio, y, costs, epochs, seed), np.arange(n)
    for i in at:
        v = ratio[rows[i]]
        margins[i] = w[rows[i]] @ v / max(1e-9, np.sqrt((v * v).sum())) + w[-1]
    slope, offset = _logistic(margins[at], y[at])
    w = _svm(rows, ratio, y, costs, epochs, seed)
    return np.concatenate([w[:-1], ratio, [w[-1], slope, offset]])


def _logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(label 1 | margin) with soft targets (Newton steps)."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g, h = p - t, np.maximum(p * (1 - p), 1e-6)
        grad = np.array([(g * m).sum() + 1e-3 * a, g.sum()])
        hess = np.array([[(h * m * m).sum() + 1e-3, (h * m).sum()], [(h * m).sum(), h.sum() + 1e-9]])
        da, db = np.linalg.solve(hess, grad)
        a, b = a - np.clip(da, -2, 2), b - np.clip(db, -2, 2)
    return float(a), float(b)


def predict(data: np.ndarray, off: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Scores in (0, 1) of a slice of texts; an empty text has only the bias."""
    dims, n = 1 << BITS, len(off) - 1
    row, feature = features(data, off)
    ratio = model[dims:2 * dims][feature]
    dot = np.bincount(row, model[:dims][feature] * ratio, n)
    norm = np.sqrt(np.bincount(row, ratio * ratio, n))
    margin = dot / np.maximum(norm, 1e-9) + model[2 * dims]
    return 1 / (1 + np.exp(-np.clip(model[2 * dims + 1] * margin + model[2 * dims + 2], -30, 30)))


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "quality", id_col: str = "doc_id", max_train: int = MAX_TRAIN) -> np.ndarray:
    """Fit on about ``max_train`` of the labelled rows.

    Rows with a null label do not count; a null text is empty.  The sample is
    fitted by one task, whose memory the bound limits; only the model comes
    back."""
    known = save(labelled.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"), F.col(text_col).alias("text"))
                 .where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < _threshold(labelled, label_col, max_train)), "quality-sample")

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids, y = [], [], []
        for batch in batches:
            data, off = tk.flat(batch.column(2))
            for i, j in tk.slices(off):
                row, feature = features(data, off[i:j + 1])
                cut = np.searchsorted(row, np.arange(j - i + 1))
                rows += [feature[cut[k]:cut[k + 1]] for k in range(j - i)]
            y += [1.0 if v > 0 else -1.0 for v in batch.column(1).to_pylist()]
            ids += [(v is not None, v) for v in batch.column(0).to_pylist()]
        order = sorted(range(len(ids)), key=lambda k: (ids[k][0], ids[k][1] or 0, y[k]))
        model = fit([rows[k] for k in order], np.array([y[k] for k in order]))
        yield pa.RecordBatch.from_arrays([pa.array([model.astype(np.float32).tobytes()], pa.binary())], names=["model"])

    out = known.repartition(1).mapInArrow(learn, "model binary").first()
    return np.frombuffer(bytes(out.model), dtype=np.float32).astype(np.float64)


def _threshold(labelled: DataFrame, label_col: str, max_train: int) -> int:
    n = labelled.where(F.col(label_col).isNotNull()).count()
    return (1 << 30) if n <= max_train else int((1 << 30) * max_train / n)


def score(docs: DataFrame, model: np.ndarray, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, score) for every row; repeated rows score alike, null text as the
    empty one, an empty table gives none.  Other columns are not read."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(batch.column(1), held.value))], names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def _scores(column, model: np.ndarray) -> np.ndarray:
    data, off = tk.flat(column)
    parts = [predict(data, off[i:j + 1], model) for i, j in tk.slices(off)]
    return np.concatenate(parts) if parts else np.zeros(0)


def keep(docs: DataFrame, model: np.ndarray, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score at least ``least``."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(at), held.value) >= least))

    return docs.mapInArrow(run, docs.schema)
