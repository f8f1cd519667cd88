"""A bound index over the fingerprint table: exact top-N that skips blocks.

``clustered`` orders the fingerprints so that similar ones stand together (by
popcount band, then by the least of their bits under fixed permutations, as in
min-wise hashing) and numbers blocks of ``BLOCK_ROWS`` rows and groups of
``GROUP_BLOCKS`` blocks.  ``signatures`` keeps of every block, and of every
group, the OR of its fingerprints and the range of its popcounts: no row can
have more bits in common with a source than the OR has, so

    min(m, hi) / (a + max(lo - m, 0))

bounds every score in it (a bits of the source, m of them in the OR, popcounts
from lo to hi).  Both are written with the fingerprint table.

``nearest`` scores each source against its ``SEEDS`` groups of the best bounds
first; its (N+1)-th score there is a lower bound t of the true one.  Then it
descends: groups whose bound reaches t, in them blocks whose bound reaches t, in
them rows.  A row that ties at the cutoff has a score of at least t, so it is
seen, and the result is the one of scoring everything.  Blocks that no source
asks for are cut by a semi join before their rows move.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tanimart import config
from tanimart.operators import blocks
from tanimart.operators import similarity as sim
from tanimart.session import materialize, ship

#: Rows of a block, blocks of a group.
BLOCK_ROWS = 32
GROUP_BLOCKS = 16
#: Groups whose rows are scored to get a source's first bound.
SEEDS = 2
#: Groups that are bounded together against a block of sources.
CHUNK_GROUPS = 8192
_PERMUTATIONS = np.stack([np.random.default_rng(seed).permutation(config.FINGERPRINT_BITS) for seed in (1, 2, 3)]).astype(np.int16)


@dataclass
class Index:
    """``rows`` (mol_id, fp, n_bits, grp, block) with the ``signatures`` (fp, lo,
    hi, n) of its blocks (grp, block) and groups (grp)."""

    rows: DataFrame
    blocks: DataFrame
    groups: DataFrame


def _least_bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(1).flatten().to_numpy().view(np.uint64).reshape(-1, config.N_WORDS)
        bits = np.unpackbits(words.astype(">u8").view(np.uint8).reshape(len(words), -1), axis=1).astype(bool)
        least = [np.where(bits, p, config.FINGERPRINT_BITS).min(axis=1, initial=config.FINGERPRINT_BITS).astype(np.int32) for p in _PERMUTATIONS]
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x) for x in least)], names=[*batch.schema.names, "k1", "k2", "k3"])


def clustered(fps: DataFrame, block_rows: int = BLOCK_ROWS, group_blocks: int = GROUP_BLOCKS) -> DataFrame:
    """(mol_id, fp, n_bits, grp, block), similar rows together; to be written."""
    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, at = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            block = first + (at + np.arange(batch.num_rows)) // block_rows
            at += batch.num_rows
            group = first + (block - first) // group_blocks
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(group), pa.array(block)], names=["mol_id", "fp", "n_bits", "grp", "block"])

    ship(fps.sparkSession)
    kind = "mol_id string, fp array<bigint>, n_bits int"
    # written first: a range shuffle computes its input twice, once to sample the ranges
    keyed = materialize(fps.select("mol_id", "fp", "n_bits").mapInArrow(_least_bits, f"{kind}, k1 int, k2 int, k3 int"))
    order = [sim.band(F.col("n_bits")), "k1", "k2", "k3", "mol_id"]
    laid = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("k1", "k2", "k3")
    return laid.mapInArrow(numbered, f"{kind}, grp long, block long")


def _or(of: DataFrame, keys: list[str], *ranges) -> DataFrame:
    words = [F.bit_or(F.col("fp")[i]).alias(f"w{i}") for i in range(config.N_WORDS)]
    merged = of.groupBy(*keys).agg(*ranges, *words)
    return merged.select(*keys, F.array(*[f"w{i}" for i in range(config.N_WORDS)]).alias("fp"), "lo", "hi", "n")


def signatures(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(signatures of blocks, signatures of groups) of ``clustered`` rows."""
    low = _or(rows, ["grp", "block"], F.min("n_bits").alias("lo"), F.max("n_bits").alias("hi"), F.count(F.lit(1)).alias("n"))
    low = materialize(low)
    return low, _or(low, ["grp"], F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))


def build(fps: DataFrame, block_rows: int = BLOCK_ROWS, group_blocks: int = GROUP_BLOCKS) -> Index:
    """The index of a fingerprint table, written to the checkpoint folder."""
    rows = materialize(clustered(fps, block_rows, group_blocks))
    low, high = signatures(rows)
    return Index(rows, low, materialize(high))


def bounds(sources: pa.Table, signs: pa.Table) -> np.ndarray:
    """Best possible score of every source in every signed block."""
    a, o = blocks.word_matrix(sources.column("fp")), np.ascontiguousarray(blocks.word_matrix(signs.column("fp")).T)
    own = sources.column("n_bits").to_numpy().astype(np.int64)[:, None]
    lo, hi = (signs.column(c).to_numpy().astype(np.int64) for c in ("lo", "hi"))
    out = np.zeros((len(a), o.shape[1]))
    step = max(1, blocks.TILE // max(1, o.shape[1]))
    for at in range(0, len(a), step):
        m = blocks.common_bits(a[at:at + step], o).astype(np.int64)
        best, least = np.minimum(m, hi), own[at:at + step] + np.maximum(lo - m, 0)
        np.divide(best, least, out=out[at:at + step], where=least > 0)
    return out


def _meet(left: DataFrame, right: DataFrame, keys: list[str], score, kind: str) -> DataFrame:
    """Cogrouped Arrow tables; the number of partitions is given, as the work is
    pairs and not bytes."""
    spark = left.sparkSession
    ship(spark)
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # no column in common with the left side
    return left.repartition(tasks, *keys).groupBy(*keys).cogroup(right.repartition(tasks, *keys).groupBy(*keys)).applyInArrow(score, kind)


def _source_blocks(n_sources: int) -> int:
    return max(1, math.ceil(n_sources / config.BLOCK_SOURCES))


def _by_source_block(left: DataFrame, right: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``r``: a source's block, and every one of them; however
    many sources ask for one group, a task gets about a block of them."""
    return (left.withColumn("r", F.pmod(F.xxhash64("mol_id", F.lit(1)), F.lit(rows)).cast("int")),
            right.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))))


def _routes(sources: DataFrame, signs: DataFrame, n_sources: int, n_signs: int, most: int | None) -> DataFrame:
    """(mol_id, grp, bound) of sources and groups: each source's ``most`` best, or
    with a column t the groups whose bound reaches it."""
    chunks = max(1, math.ceil(n_signs / CHUNK_GROUPS))
    left, right = _by_source_block(sources.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))),
                                   signs.withColumn("c", F.pmod(F.xxhash64("grp"), F.lit(chunks)).cast("int")), _source_blocks(n_sources))

    def route(some: pa.Table, groups: pa.Table) -> pa.Table:
        if not len(some) or not len(groups):
            i = j = np.zeros(0, np.int64)
            value = np.zeros(0)
            ids, grp = pa.array([], pa.string()), pa.array([], pa.int64())
        else:
            limit = bounds(some, groups)
            if most is None:
                i, j = np.nonzero(limit >= some.column("t").to_numpy()[:, None])
            else:
                places = [blocks.first_rows(row, most) for row in limit]
                i, j = np.repeat(np.arange(len(limit)), [len(p) for p in places]), np.concatenate(places)
            value, ids, grp = limit[i, j], some.column("mol_id").take(pa.array(i)), groups.column("grp").take(pa.array(j))
        return pa.table({"mol_id": ids, "grp": grp, "bound": pa.array(value)})

    found = _meet(left, right, ["r", "c"], route, "mol_id string, grp long, bound double")
    if most is None:
        return found
    order = Window.partitionBy("mol_id").orderBy(F.desc("bound"), "grp")
    return found.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= most).drop("k")


def _descend(routed: DataFrame, low: DataFrame, rows: int) -> DataFrame:
    """(mol_id, grp, block, n) of blocks whose bound reaches the source's t."""
    def down(some: pa.Table, signs: pa.Table) -> pa.Table:
        if not len(some) or not len(signs):
            return pa.schema([("mol_id", pa.string()), ("grp", pa.int64()), ("block", pa.int64()), ("n", pa.int64())]).empty_table()
        i, j = (pa.array(x) for x in np.nonzero(bounds(some, signs) >= some.column("t").to_numpy()[:, None]))
        return pa.table({"mol_id": some.column("mol_id").take(i), "grp": signs.column("grp").take(j),
                         "block": signs.column("block").take(j), "n": signs.column("n").take(j)})

    return _meet(*_by_source_block(routed, low, rows), ["grp", "r"], down, "mol_id string, grp long, block long, n long")


def _scored(wanted: DataFrame, rows: DataFrame, source_blocks: int, n: int, exclude_self: bool) -> DataFrame:
    """First ``n`` rows of every source in its wanted blocks of a group, without
    those below its t; ``wanted`` is (mol_id, fp, n_bits, t, grp, asked: array of
    blocks)."""
    def score(some: pa.Table, candidates: pa.Table) -> pa.Table:
        if not len(some) or not len(candidates):
            return blocks.best(some, candidates, n, exclude_self)
        asked = some.column("asked").combine_chunks()
        who, which = np.repeat(np.arange(len(some)), asked.value_lengths().to_numpy()), asked.flatten().to_numpy()
        candidates = blocks.in_order(candidates)
        held, scores = candidates.column("block").to_numpy(), np.full((len(some), len(candidates)), -1.0)
        for b in np.unique(which).tolist():
            i, j = who[which == b], np.flatnonzero(held == b)
            for at, part in blocks.tiles(some.take(pa.array(i)), candidates.take(pa.array(j))):
                scores[np.ix_(i[at:at + len(part)], j)] = part
        scores[scores < some.column("t").to_numpy()[:, None]] = -1.0
        return blocks.firsts(some, candidates, [(0, scores)], n, exclude_self)

    keyed = rows.where("mol_id IS NOT NULL").select("mol_id", "fp", "n_bits", "grp", "block", blocks.order_key("mol_id").alias("order_key"))
    return _meet(*_by_source_block(wanted, keyed, source_blocks), ["grp", "r"], score, "source_id string, target_id string, score double")


def _of(sources: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` (mol_id, grp, block) as the wanted blocks by group of sources with t."""
    asked = pairs.groupBy("mol_id", "grp").agg(F.collect_set("block").alias("asked"))  # at most GROUP_BLOCKS
    return sources.select("mol_id", "fp", "n_bits", "t").join(asked, "mol_id")


def _with_least(sources: DataFrame, first: DataFrame, n: int) -> DataFrame:
    """``sources`` with t, the score of their last of ``n`` + 1 first rows: a row
    of the result has at least that."""
    least = first.filter(F.col("rank") == n + 1).select(F.col("source_id").alias("mol_id"), F.col("score").alias("_t"))
    return sources.join(least, "mol_id", "left").withColumn("t", F.coalesce("_t", F.lit(0.0))).drop("_t")


def plan(sources: DataFrame, index: Index, n: int = config.TOP_N, exclude_self: bool = True) -> tuple[DataFrame, DataFrame]:
    """(first rows, blocks still to score): the seeds' first ``n`` + 1 rows per
    source with their rank, and (mol_id, grp, block, n) of the blocks besides the
    seeds that can hold a row of the result."""
    sources = materialize(sources.where("mol_id IS NOT NULL").select("mol_id", "fp", "n_bits"))
    n_sources, n_groups = sources.count(), index.groups.count()
    seeds = materialize(_routes(sources, index.groups, n_sources, n_groups, SEEDS))
    own = seeds.join(index.blocks.select("grp", "block"), "grp").select("mol_id", "grp", "block")
    near = index.rows.join(seeds.select("grp").distinct(), "grp", "left_semi")
    first = materialize(sim.ranked(_scored(_of(sources.withColumn("t", F.lit(0.0)), own), near, _source_blocks(n_sources), n + 1, exclude_self), n + 1))
    bounded = materialize(_with_least(sources, first, n))
    groups = _routes(bounded, index.groups, n_sources, n_groups, None).join(seeds, ["mol_id", "grp"], "left_anti")
    routed = bounded.join(groups.select("mol_id", "grp"), "mol_id")
    return first, materialize(_descend(routed, index.blocks, _source_blocks(n_sources)))


def head(sources: DataFrame, index: Index, n: int = config.TOP_N, exclude_self: bool = True) -> DataFrame:
    """``similarity.head`` by the index: (source_id, target_id, score, rank)."""
    first, more = plan(sources, index, n, exclude_self)
    rows = index.rows.join(more.select("block").distinct(), "block", "left_semi")
    rest = _scored(_of(_with_least(sources, first, n), more), rows, _source_blocks(sources.count()), n + 1, exclude_self)
    return sim.ranked(first.drop("rank").unionByName(rest), n + 1)


def nearest(sources: DataFrame, index: Index, n: int = config.TOP_N, exclude_self: bool = True) -> DataFrame:
    """``similarity.nearest`` by the index."""
    return sim.flagged(head(sources, index, n, exclude_self), n)


def pairs_scored(sources: DataFrame, index: Index, n: int = config.TOP_N, exclude_self: bool = True) -> tuple[int, int]:
    """(pairs that ``nearest`` scores, pairs there are)."""
    _, more = plan(sources, index, n, exclude_self)
    n_sources, n_groups = sources.count(), index.groups.count()
    seeds = _routes(sources.select("mol_id", "fp", "n_bits"), index.groups, n_sources, n_groups, SEEDS).join(index.groups.select("grp", "n"), "grp")
    total = lambda df: df.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return total(more) + total(seeds), n_sources * total(index.groups)
