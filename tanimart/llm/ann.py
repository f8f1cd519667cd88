"""Nearest neighbours by collision counting.

Vectors are mapped so that the largest inner product is the smallest distance
(scaled into the unit ball, one coordinate added that completes the norm to
1).  Each block of vectors keeps one sorted array per random projection.  For
a query, a window centred on its own projection is opened in every array and
widened step by step (virtual rehashing: one array serves all radii); a vector
that lies in at least THRESHOLD of the windows is verified with its exact
score.  A query stops when its k-th verified distance is within the current
radius: a vector that near lies in each window with probability 0.83.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Projections, collisions that make a candidate, half width of a window per
#: unit of radius, first radius and factor of the radii.
PROJECTIONS = 16
THRESHOLD = 11
HALF_WIDTH = 1.36
FIRST_RADIUS = 0.8
FACTOR = 1.2
#: Rows of a block (one index), queries counted together, queries per pass.
BLOCK_ROWS = 16_384
CHUNK = 64
QUERY_BLOCK = 20_000


class Block:
    """Sorted projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, planes: np.ndarray):
        self.ids, self.vectors, self.largest, self.planes = ids, vectors, largest, planes
        unit = vectors / largest
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", unit, unit)))
        at = unit @ planes[:-1] + rest[:, None] * planes[-1]
        self.order = np.argsort(at, axis=0, kind="stable").T.astype(np.int32).copy()
        self.sorted = np.take_along_axis(at.T, self.order, axis=1)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query id, vector ids, scores) of each query's k best verified here."""
        n = len(self.ids)
        length = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        centre = (queries / length[:, None]) @ self.planes[:-1]
        for at in range(0, len(queries), CHUNK):
            live = np.arange(at, min(at + CHUNK, len(queries)))
            counts = np.zeros((len(live), n), dtype=np.uint8)
            seen = np.zeros((len(live), n), dtype=bool)
            best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in live]
            lo = np.array([np.searchsorted(s, centre[live, p]) for p, s in enumerate(self.sorted)])
            hi, base, radius = lo.copy(), at, FIRST_RADIUS
            while len(live):
                left, right = np.empty((2, PROJECTIONS, len(live)), dtype=np.int64)
                for p, s in enumerate(self.sorted):
                    left[p] = np.searchsorted(s, centre[live, p] - HALF_WIDTH * radius, "left")
                    right[p] = np.searchsorted(s, centre[live, p] + HALF_WIDTH * radius, "right")
                rows = live - base
                gains = zip(rows.tolist(), left.T.tolist(), lo[:, rows].T.tolist(), hi[:, rows].T.tolist(), right.T.tolist(), strict=True)
                for row, a, b, c, d in gains:  # only what the windows gain
                    got = [o[x:y] for o, w, x, y, z in zip(self.order, a, b, c, d, strict=True) for x, y in ((w, x), (y, z)) if x < y]
                    if got:
                        counts[row] += np.bincount(np.concatenate(got), minlength=n).astype(np.uint8)
                lo[:, rows], hi[:, rows] = left, right
                going = []
                for q in live:
                    row = q - base
                    new = np.flatnonzero((counts[row] >= THRESHOLD) & ~seen[row])
                    if len(new):
                        seen[row, new] = True
                        best[row] = self._verified(best[row], new, query_ids[q], queries[q], k)
                    everything = lo[0, row] == 0 and hi[0, row] == n and (lo[:, row] == 0).all() and (hi[:, row] == n).all()
                    if not (everything or self._near(best[row][1], length[q], radius, k)):
                        going.append(q)
                live, radius = np.array(going, dtype=np.int64), radius * FACTOR
            for row, (ids, scores) in enumerate(best):
                yield int(query_ids[base + row]), ids, scores

    def _verified(self, best, new, own, query, k):
        scores = np.einsum("ij,j->i", self.vectors[new], query)
        other = self.ids[new] != own
        ids, scores = np.concatenate([best[0], self.ids[new][other]]), np.concatenate([best[1], scores[other]])
        if len(ids) > 4 * k:
            edge = np.partition(scores, len(scores) - k)[len(scores) - k]
            ids, scores = ids[scores >= edge], scores[scores >= edge]
        order = np.lexsort((ids, -scores))[:k]
        return ids[order], scores[order]

    def _near(self, scores, length, radius, k):
        if len(scores) < k:
            return False
        distance = np.sqrt(max(0.0, 2.0 - 2.0 * scores[k - 1] / (length * self.largest)))
        return distance <= radius


def _usable(column: str):
    """Vectors that take part: not null, without null or non-finite parts, not zero."""
    return (
        F.col(column).isNotNull() & (F.size(column) > 0)
        & ~F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(column, lambda x: x != 0)
    )


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest inner products
    among ``vectors`` found, its own id left out; ties go to the smaller id.

    All vectors must have one dimension (else an error).  Null, zero and
    non-finite vectors and rows with a null id take no part; repeated rows of an
    id count once; fewer than k others give fewer rows; empty tables give none.
    Every row is indexed.  The query set is taken in blocks of bounded size, each
    sent to all tasks; only the k best per query and block are shuffled.
    """
    def clean(df):
        return df.where(F.col(id_col).isNotNull() & _usable(vector_col)).select(
            F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))

    rows, asked = clean(vectors), clean(queries)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    facts = rows.agg(F.count("*").alias("n"), F.max(norm).alias("largest"), F.max(F.size("v")).alias("dim"), F.min(F.size("v")).alias("least")).first()
    kind = "query_id long, vec_id long, score double"
    spark = vectors.sparkSession
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    if facts.dim is None:
        found = spark.createDataFrame([], kind)
    else:
        if facts.dim != facts.least:
            raise ValueError("vectors of different dimension")
        planes = np.random.default_rng(seed).standard_normal((facts.dim + 1, PROJECTIONS))
        largest = facts.largest * (1 + 1e-12)
        count = asked.count()
        blocks = max(1, -(-count // QUERY_BLOCK))
        found = None
        for b in range(blocks):
            own = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).dropDuplicates(["id"]).collect()
            own.sort(key=lambda r: r.id)
            held = spark.sparkContext.broadcast((np.array([r.id for r in own], np.int64), np.array([r.v for r in own], np.float64).reshape(len(own), facts.dim)))

            def run(batches: Iterable[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
                ids, parts = [], []

                def answer():
                    if not ids or not len(held.value[0]):
                        return
                    block = Block(np.concatenate(ids), np.concatenate(parts), largest, planes)
                    out = list(block.search(*held.value, k))
                    for i in range(0, len(out), 1024):
                        some = out[i:i + 1024]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.repeat([q for q, _, _ in some], [len(x) for _, x, _ in some]).astype(np.int64)),
                            pa.array(np.concatenate([x for _, x, _ in some])), pa.array(np.concatenate([s for _, _, s in some]))],
                            names=["query_id", "vec_id", "score"])

                for batch in batches:
                    v = batch.column(1)
                    flat = v.flatten().to_numpy(zero_copy_only=False)
                    ids.append(batch.column(0).to_numpy())
                    parts.append(flat.reshape(len(v), -1))
                    if sum(map(len, ids)) >= BLOCK_ROWS:
                        yield from answer()
                        ids, parts = [], []
                yield from answer()

            # the best k of a query and id, once per id
            # (fewer, larger blocks where the scan has small splits)
            part = rows.coalesce(max(1, -(-facts.n // BLOCK_ROWS))).mapInArrow(run, kind).distinct()
            found = part if found is None else found.union(part)
    best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
