"""The similarity chain: catalogue -> fingerprints -> scores -> top N.

Sources are the distinct catalogue ids that the matched input refers to; the
registered flagship takes every benchmark item as its input instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tanimart import config
from tanimart.operators import bound_index, clean, lookup, match, validate
from tanimart.operators import fingerprints as fpo
from tanimart.operators import similarity as sim
from tanimart.plans import inputs
from tanimart.session import materialize
from tanimart.sources import tables


def valid_molecules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue entries whose structure text is valid."""
    return validate.split(tables.molecules(spark, sf_dir))[0]


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores where its scan has fewer tasks than cores (files
    of one row group do not split); larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def catalogue_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mol_id, fp, n_bits) for every catalogue entry with a feature.

    An entry is valid when it has a feature, so no other check reads its text."""
    return fpo.fingerprints(spread(tables.molecules(spark, sf_dir).select("mol_id", "text")))


def matched_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct catalogue ids that the raw input's names match."""
    typed = clean.typed_input(inputs.catalogue_batch(spark, sf_dir))
    matched = match.match_names(typed, inputs.catalogue_dictionary(spark, sf_dir), match.overrides_frame(spark))
    return lookup.requested_ids(matched, "matched_id")


def _nearest(spark: SparkSession, sf_dir: str, ids: DataFrame, n: int) -> DataFrame:
    fps = materialize(catalogue_fingerprints(spark, sf_dir))  # hashed once, read by both passes
    return sim.nearest(materialize(lookup.found(fps, ids)), fps, n)  # the sources are read several times


def fact_similarity(spark: SparkSession, sf_dir: str, n: int = config.TOP_N) -> DataFrame:
    """The fact for all benchmark items: top ``n`` with rank and tie flag."""
    return _nearest(spark, sf_dir, lookup.requested_ids(tables.source_requests(spark, sf_dir)), n)


def matched_fact(spark: SparkSession, sf_dir: str, n: int = config.TOP_N) -> DataFrame:
    """The fact for the sources of the matched input."""
    return _nearest(spark, sf_dir, matched_sources(spark, sf_dir), n)


def scored(spark: SparkSession, sf_dir: str, least: float = 0.0) -> DataFrame:
    """Every benchmark item's pairs that score at least ``least``."""
    fps = materialize(catalogue_fingerprints(spark, sf_dir))
    ids = lookup.requested_ids(tables.source_requests(spark, sf_dir))
    return sim.score_pairs(materialize(lookup.found(fps, ids)), fps, least=least)


def earlier_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mol_id, text): the catalogue as it may have been before.  Of three parts
    (by a hash of the id) one is not there yet, one has the first half of its
    texts, one is as now; and of every fourth benchmark item there is another
    entry, which has left since."""
    now = tables.molecules(spark, sf_dir).select("mol_id", "text")
    part = F.pmod(F.crc32(F.col("mol_id").cast("binary")), F.lit(3))
    half = F.expr("substring(text, 1, CAST(length(text) / 2 AS INT))")
    items = tables.read_table(spark, sf_dir, "benchmark", ["item_id", "text"]).filter("item_id % 4 = 0")
    return (now.filter(part != 0).select("mol_id", F.when(part == 1, half).otherwise(F.col("text")).alias("text"))
            .unionByName(items.select(F.concat(F.lit("R"), F.col("item_id").cast("string")).alias("mol_id"), "text")))


def maintained_fact(spark: SparkSession, sf_dir: str, n: int = config.TOP_N) -> DataFrame:
    """The fact for all benchmark items, kept up from the earlier catalogue's: only
    entries that came or changed, and sources that lost a row, are scored."""
    before = materialize(fpo.fingerprints(spread(earlier_catalogue(spark, sf_dir))))
    fps = materialize(catalogue_fingerprints(spark, sf_dir))
    ids = lookup.requested_ids(tables.source_requests(spark, sf_dir))
    state = sim.head(materialize(lookup.found(before, ids)), before, n)
    return sim.flagged(sim.maintained(state, materialize(lookup.found(fps, ids)), fps, *sim.changes(before, fps), n), n)


def indexed_fact(spark: SparkSession, sf_dir: str, n: int = config.TOP_N) -> DataFrame:
    """The fact for all benchmark items by the bound index of the catalogue."""
    fps = catalogue_fingerprints(spark, sf_dir)
    index = bound_index.build(fps)
    ids = lookup.requested_ids(tables.source_requests(spark, sf_dir))
    return bound_index.nearest(materialize(lookup.found(index.rows, ids)), index, n)  # the sources are read several times
