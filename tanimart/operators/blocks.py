"""Block kernel: Tanimoto scores of blocks of sources against blocks of candidates.

Sources and candidates meet as cogrouped Arrow tables, one pair of tables per
(band, source block, candidate block).  A table's fingerprints are one matrix
of 64-bit words; the common bits of all pairs are an AND and a bit count per
word over a tile that stays in the processor's cache.  What leaves a block is
each source's best rows, or the pairs from a given score on.

Blocks are dealt by a hash of the id, so a group holds about
``config.BLOCK_SOURCES`` and ``config.BLOCK_CANDIDATES`` rows of 256 bytes
whatever the size of either side: a source travels once per candidate block of
its bands, a candidate once per source block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tanimart import config
from tanimart.session import ship

#: Pairs scored together.
TILE = 1 << 17


def order_key(target: str) -> Column:
    """Text whose order is that of candidates with one score: by the text before
    the key's digits, then the digits as a number ('D9' before 'D10'; none
    first), then the whole text."""
    c = F.col(target)
    number = F.regexp_extract(c, "([0-9]+)$", 1).try_cast("decimal(38,0)").cast("string")
    return F.concat(F.regexp_replace(c, "[0-9]+$", ""), F.lit("\x00"),
                    F.coalesce(F.concat(F.lit("1"), F.lpad(number, 38, "0")), F.lit("0")), F.lit("\x00"), c)


def word_matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Fingerprints of an ARRAY<BIGINT> column as rows of unsigned words."""
    return column.combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(column), config.N_WORDS)


def common_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """|A AND B| of every row of ``a`` with every column of ``b`` (words x rows)."""
    out = np.zeros((len(a), b.shape[1]), dtype=np.uint16)
    for w in range(len(b)):
        out += np.bitwise_count(a[:, w, None] & b[w])
    return out


def tiles(sources: pa.Table, candidates: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(first source, scores) of consecutive sources against all candidates.

    Two empty fingerprints score 0.0."""
    a, b = word_matrix(sources.column("fp")), np.ascontiguousarray(word_matrix(candidates.column("fp")).T)
    own, other = (t.column("n_bits").to_numpy().astype(np.int32) for t in (sources, candidates))
    step = max(1, TILE // max(1, len(other)))
    for at in range(0, len(a), step):
        inter = common_bits(a[at:at + step], b).astype(np.int32)
        union = own[at:at + step, None] + other - inter
        yield at, np.divide(inter, union, out=np.zeros(inter.shape), where=union > 0)


def _selves(sources: pa.Table, candidates: pa.Table) -> dict[int, list[int]]:
    """Candidates that are the source itself, by source."""
    at: dict = {}
    for j, i in enumerate(candidates.column("mol_id").to_pylist()):
        at.setdefault(i, []).append(j)
    return {k: at[i] for k, i in enumerate(sources.column("mol_id").to_pylist()) if i in at}


def first_rows(scores: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` places by falling score, then by place; negative scores
    do not count."""
    if n < len(scores):
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        above = np.flatnonzero(scores > least)
        rows = np.concatenate([above, np.flatnonzero(scores == least)[:n - len(above)]])
    else:
        rows = np.arange(len(scores))
    return rows[scores[rows] >= 0]


def _result(sources: pa.Table, candidates: pa.Table, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    if not found:
        return pa.schema([("source_id", pa.string()), ("target_id", pa.string()), ("score", pa.float64())]).empty_table()
    i, j, score = (np.concatenate(x) for x in zip(*found, strict=True))
    return pa.table({"source_id": sources.column("mol_id").take(pa.array(i)), "target_id": candidates.column("mol_id").take(pa.array(j)),
                     "score": pa.array(score)})


def best(sources: pa.Table, candidates: pa.Table, n: int, exclude_self: bool) -> pa.Table:
    """(source_id, target_id, score): the first ``n`` candidates of every source."""
    if not len(sources) or not len(candidates):
        return _result(sources, candidates, [])
    candidates = in_order(candidates)
    return firsts(sources, candidates, tiles(sources, candidates), n, exclude_self)


def in_order(candidates: pa.Table) -> pa.Table:
    """Candidates by their ``order_key``."""
    keys = candidates.column("order_key").to_pylist()
    return candidates.take(pa.array(sorted(range(len(keys)), key=keys.__getitem__)))


def firsts(sources: pa.Table, candidates: pa.Table, scored: Iterable[tuple[int, np.ndarray]], n: int, exclude_self: bool) -> pa.Table:
    """``best`` of candidates in order, from (first source, scores) as ``tiles``
    gives them; a negative score is none."""
    selves = _selves(sources, candidates) if exclude_self else {}
    found = []
    for at, scores in scored:
        for k, row in enumerate(scores):
            row[selves.get(at + k, [])] = -1.0
            places = first_rows(row, n)
            found.append((np.full(len(places), at + k), places, row[places]))
    return _result(sources, candidates, found)


def above(sources: pa.Table, candidates: pa.Table, least: float, exclude_self: bool) -> pa.Table:
    """(source_id, target_id, score): the pairs that score at least ``least``."""
    if not len(sources) or not len(candidates):
        return _result(sources, candidates, [])
    selves = _selves(sources, candidates) if exclude_self else {}
    found = []
    for at, scores in tiles(sources, candidates):
        for k in range(len(scores)):
            scores[k, selves.get(at + k, [])] = -1.0
        i, j = np.nonzero(scores >= max(0.0, least))
        found.append((i + at, j, scores[i, j]))
    return _result(sources, candidates, found)


_PAIR = "source_id string, target_id string, score double"
_KEYS = ("band", "source_block", "candidate_block")


def meet(routed: DataFrame, candidates: DataFrame, salts: Column, source_blocks: int, exclude_self: bool,
         n: int | None = None, least: float = 0.0) -> DataFrame:
    """(source_id, target_id, score) of sources and candidates with one band.

    ``routed`` is (mol_id, fp, n_bits, band, salts): a source once per band it
    is to be scored in; ``candidates`` is (mol_id, fp, n_bits, band), ``salts``
    the number of candidate blocks of their band.  With ``n`` each source's
    first ``n`` of every block, else the pairs from ``least`` on.  Rows without
    an id are neither source nor candidate.
    """
    left = (routed.where("mol_id IS NOT NULL")
            .withColumn("source_block", F.pmod(F.xxhash64("mol_id", F.lit(1)), F.lit(source_blocks)).cast("int"))
            .select("mol_id", "fp", "n_bits", "band", "source_block", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("candidate_block")))
    # columns of its own: sources are often rows of the same frame, and a cogroup
    # passes a column that both sides share to one of them only
    right = (candidates.where("mol_id IS NOT NULL").withColumn("candidate_block", F.pmod(F.xxhash64("mol_id"), salts).cast("int"))
             .select(*[F.col(c).alias(c) for c in ("mol_id", "fp", "n_bits", "band", "candidate_block")])
             .select("mol_id", "fp", "n_bits", "band", "candidate_block", F.explode(F.sequence(F.lit(0), F.lit(source_blocks - 1))).alias("source_block"),
                     *([order_key("mol_id").alias("order_key")] if n else [])))
    # the work is pairs, not bytes: a given number of partitions is not coalesced
    spark = candidates.sparkSession
    ship(spark)
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def score(sources: pa.Table, others: pa.Table) -> pa.Table:
        return best(sources, others, n, exclude_self) if n else above(sources, others, least, exclude_self)

    return (left.repartition(tasks, *_KEYS).groupBy(*_KEYS)
            .cogroup(right.repartition(tasks, *_KEYS).groupBy(*_KEYS)).applyInArrow(score, _PAIR))
