"""Scoring sources against candidates, and the top-N with tie flag.

Fingerprints fall into bands of similar popcount.  A source with a bits and a
band whose popcounts reach from l to h cannot score above min(a, h) / max(a, l)
there, so a band is scored only where that bound can matter.  Within a band
sources and candidates meet as blocks (``operators.blocks``); neither side has
to fit into one executor.

``nearest`` needs two passes.  The first scores a source against its own band
and the bands next to it; the score of its (N+1)-th candidate is a lower
bound t for the true (N+1)-th score.  The second scores only the other bands
whose bound reaches t.  Ties at the cutoff have scores of at least t, so they
are all seen and the result is exact.

``head`` keeps N+1 rows of every source.  That is all the fact needs (the
last row decides the tie flag), and all that ``maintained`` needs to follow
changes of the catalogue without scoring what did not change.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tanimart import config
from tanimart.operators import blocks
from tanimart.session import materialize

#: Ratio of neighbouring band limits.
BAND_RATIO = 1.25


def band(n_bits: Column) -> Column:
    """Band number of a popcount; entries without bits are a band of their own."""
    return F.when(n_bits > 0, F.floor(F.log(n_bits.cast("double")) / math.log(BAND_RATIO))).otherwise(F.lit(-1)).cast("int")


def _bands(candidates: DataFrame) -> list:
    """(band, least bits, most bits, candidate blocks) of the candidates' bands:
    at most log(FINGERPRINT_BITS) / log(BAND_RATIO) + 2 rows."""
    rows = (candidates.groupBy(band(F.col("n_bits")).alias("band"))
            .agg(F.min("n_bits").alias("lo"), F.max("n_bits").alias("hi"), F.count(F.lit(1)).alias("n")).collect())
    return sorted((r.band, r.lo, r.hi, math.ceil(r.n / config.BLOCK_CANDIDATES)) for r in rows)


def _source_blocks(sources: DataFrame) -> int:
    return max(1, math.ceil(sources.count() / config.BLOCK_SOURCES))


def _reachable(bands: list) -> Column:
    """ARRAY of (band, bound, salts): the best score of n_bits in every band.

    SQL text: one parse instead of some hundred calls."""
    bound = "IF(n_bits = 0 OR {hi} = 0, 0D, least(n_bits, {hi}) / CAST(greatest(n_bits, {lo}) AS DOUBLE))"
    rows = [f"named_struct('band', {b}, 'bound', {bound.format(lo=lo, hi=hi)}, 'salts', {salts})" for b, lo, hi, salts in bands]
    return F.expr(f"array({', '.join(rows)})")


def _met(routed: DataFrame, candidates: DataFrame, bands: list, source_blocks: int, exclude_self: bool, **kw) -> DataFrame:
    """``blocks.meet`` over the candidates of ``bands``."""
    salts = F.expr(f"map({', '.join(f'{b}, {s}' for b, _, _, s in bands)})")
    banded = candidates.select("mol_id", "fp", "n_bits", band(F.col("n_bits")).alias("band")).filter(F.col("band").isin([b[0] for b in bands]))
    return blocks.meet(routed, banded, salts[F.col("band")], source_blocks, exclude_self, **kw)


def score_pairs(sources: DataFrame, candidates: DataFrame, exclude_self: bool = True, least: float = 0.0) -> DataFrame:
    """(source_id, target_id, score) of the pairs that score at least ``least``.

    ``sources`` and ``candidates`` are (mol_id, fp, n_bits).  With the default
    every pair is returned, as many as sources times candidates."""
    bands = _bands(candidates)
    if not bands:
        return _none(candidates)
    routed = sources.withColumn("_r", F.explode(_reachable(bands))).filter(F.col("_r.bound") >= least)
    return _met(routed.select("mol_id", "fp", "n_bits", "_r.band", "_r.salts"), candidates, bands, _source_blocks(sources), exclude_self, least=least)


def _none(candidates: DataFrame) -> DataFrame:
    return candidates.select(F.col("mol_id").alias("source_id"), F.col("mol_id").alias("target_id"), F.lit(0.0).alias("score")).limit(0)


def head(sources: DataFrame, candidates: DataFrame, n: int = config.TOP_N, exclude_self: bool = True) -> DataFrame:
    """(source_id, target_id, score, rank): the first ``n`` + 1 candidates of
    every source, scoring only the bands that can hold them."""
    bands = _bands(candidates)
    if not bands:
        return ranked(_none(candidates), n + 1)
    source_blocks = _source_blocks(sources)
    routes = (sources.withColumn("_own", band(F.col("n_bits"))).withColumn("_r", F.explode(_reachable(bands)))
              .select("mol_id", "fp", "n_bits", "_own", "_r.*"))
    near = F.abs(F.col("band") - F.col("_own")) <= 1
    first = materialize(ranked(_met(routes.filter(near), candidates, bands, source_blocks, exclude_self, n=n + 1), n + 1))
    bound = first.filter(F.col("rank") == n + 1).select(F.col("source_id").alias("mol_id"), F.col("score").alias("_t"))
    others = materialize(routes.filter(~near).join(bound, "mol_id", "left").filter(F.col("bound") >= F.coalesce("_t", F.lit(0.0))))
    asked = {r.band for r in others.select("band").distinct().collect()}  # of the bands above
    if not asked:
        return first
    rest = _met(others, candidates, [b for b in bands if b[0] in asked], source_blocks, exclude_self, n=n + 1)
    return ranked(first.drop("rank").unionByName(rest), n + 1)


def nearest(sources: DataFrame, candidates: DataFrame, n: int = config.TOP_N, exclude_self: bool = True) -> DataFrame:
    """The top ``n`` of every source as ``top_n`` defines them."""
    return flagged(head(sources, candidates, n, exclude_self), n)


def changes(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(removed ids, added entries) that lead from one fingerprint table to
    another; an entry whose fingerprint changed is in both.  Ids are unique."""
    old, new = before.select("mol_id", F.col("fp").alias("_old")), after.select("mol_id", F.col("fp").alias("_new"))
    gone = old.join(new, "mol_id", "left").filter(F.col("_new").isNull() | (F.col("_new") != F.col("_old"))).select("mol_id")
    come = after.join(old, "mol_id", "left").filter(F.col("_old").isNull() | (F.col("_old") != F.col("fp"))).select(after.columns)
    return gone, come


def maintained(state: DataFrame, sources: DataFrame, candidates: DataFrame, removed: DataFrame, added: DataFrame,
               n: int = config.TOP_N, exclude_self: bool = True) -> DataFrame:
    """The head of ``sources`` over ``candidates``, from the head ``state`` of an
    earlier catalogue that differs by the ids ``removed`` and the entries
    ``added`` (see ``changes``).

    A source is scored against all candidates if the state does not hold it, if
    its own fingerprint changed, or if one of its rows is gone: rows beyond the
    state may then move up.  Every other source is scored against the added
    entries only; what its state left out stays behind its last row.  Sources
    that are no longer asked for leave.  Ids are unique.
    """
    state = materialize(state.select("source_id", "target_id", "score"))
    gone = materialize(removed.select("mol_id").distinct())
    held = state.select(F.col("source_id").alias("mol_id")).distinct()
    hit = (state.join(gone, state.target_id == gone.mol_id, "left_semi").select(F.col("source_id").alias("mol_id"))
           .unionByName(gone).distinct())
    same = materialize(sources.join(held, "mol_id", "left_semi").join(hit, "mol_id", "left_anti"))
    anew = sources.join(same.select("mol_id"), "mol_id", "left_anti")
    kept = state.join(same.select(F.col("mol_id").alias("source_id")), "source_id", "left_semi")
    grown = kept.unionByName(head(same, added, n, exclude_self).drop("rank"))
    return ranked(grown, n + 1).unionByName(head(materialize(anew), candidates, n, exclude_self))


def narrow_scores(df: DataFrame, col: str = "score") -> DataFrame:
    """Scores as float32 (storage width of the original warehouse).

    Optional: ranks and ties are unchanged, since two distinct Tanimoto
    values with denominators <= 2048 differ by more than a float32 step.
    """
    return df.withColumn(col, F.col(col).cast("float"))


def candidate_order(target: str = "target_id") -> list[Column]:
    """Order of candidates with one score (``blocks.order_key``)."""
    return [blocks.order_key(target).asc()]


def ranked(pairs: DataFrame, n: int) -> DataFrame:
    """The first ``n`` pairs of every source with their rank (a limit per
    source that each task applies before the shuffle)."""
    by_score = Window.partitionBy("source_id").orderBy(F.col("score").desc(), *candidate_order())
    return pairs.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= n)


def top_n(pairs: DataFrame, n: int = config.TOP_N) -> DataFrame:
    """Top ``n`` targets per source with the cutoff-tie flag, from any pairs.

    Order is score descending, then ``candidate_order``.  Only n+1 rows per
    source are ever needed, and the row_number filter stays a map-side
    WindowGroupLimit.
    """
    return flagged(ranked(pairs, n + 1), n)


def flagged(ranked: DataFrame, n: int = config.TOP_N) -> DataFrame:
    """The fact's rows from a head of n+1 rows per source.

    ``rank`` is 1..k without gaps.  ``tied_at_cutoff`` is true for a kept row
    whose score equals the last kept score when at least one row with that score
    was left out -- which is the case exactly when the (n+1)-th row has the last
    kept score.
    """
    whole = Window.partitionBy("source_id")
    cut = F.max(F.when(F.col("rank") == n, F.col("score"))).over(whole)
    spill = F.max(F.when(F.col("rank") == n + 1, F.col("score"))).over(whole)
    tied = (F.coalesce(spill == cut, F.lit(False)) & (F.col("score") == cut))
    return (ranked.withColumn("tied_at_cutoff", tied)
            .filter(F.col("rank") <= n)
            .select("source_id", "target_id", "score", F.col("rank").cast("int").alias("rank"),
                    "tied_at_cutoff"))
