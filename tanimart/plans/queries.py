"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the given tables (or what Spark derives from them) in
full; see ``oracle_sql`` for the equivalent SQL of each one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tanimart import config
from tanimart.functions import fingerprint as fpx
from tanimart.functions import text as tx
from tanimart.operators import clean, featurise, lookup, match, paging, validate
from tanimart.operators import fingerprints as fpo
from tanimart.operators import similarity as sim
from tanimart.plans import build, inputs, loadlog, mart
from tanimart.plans import similarity as simplan
from tanimart.session import ensure_checkpoint_dir, materialize
from tanimart.sources import csv_ingest, tables
from tanimart.streaming import file_ingest

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@register
def flagship_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-10 Tanimoto neighbours per benchmark source, with tie flag."""
    return simplan.fact_similarity(spark, sf_dir)


@register
def matched_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw batch -> name match -> distinct matched ids -> their top-10."""
    return simplan.matched_fact(spark, sf_dir)


@register
def maintained_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship's result, kept up from an earlier state of the catalogue."""
    return simplan.maintained_fact(spark, sf_dir)


@register
def indexed_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship's result by the bound index, which skips blocks."""
    return simplan.indexed_fact(spark, sf_dir)


# --- the mart (over the matched input's fact) ---------------------------------

def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matched input's fact, computed once (the views read it repeatedly)."""
    return materialize(simplan.matched_fact(spark, sf_dir))


def _dim(spark: SparkSession, sf_dir: str, fact: DataFrame) -> DataFrame:
    return mart.dimension(fact, tables.molecules(spark, sf_dir), tables.properties(spark, sf_dir))


@register
def scoped_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension rows for every id the fact references."""
    return _dim(spark, sf_dir, _fact(spark, sf_dir))


@register
def avg_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.average_per_source(simplan.matched_fact(spark, sf_dir))


@register
def property_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _fact(spark, sf_dir)
    return mart.property_deviation(fact, _dim(spark, sf_dir, fact), "quality")


@register
def sample_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten sources of the fact.  Every source with a fingerprint has
    candidates, so the found sources are the fact's, and nothing is scored."""
    mols, _ = validate.split(lookup.found(tables.molecules(spark, sf_dir), simplan.matched_sources(spark, sf_dir)))
    return mart.sampled_sources(mols.select(F.col("mol_id").alias("source_id")))


@register
def pivot_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.pivot_sources(_fact(spark, sf_dir))


@register
def neighbor_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.neighbor_chain(simplan.matched_fact(spark, sf_dir))


@register
def grouped_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grains over labels that many sources lack: genuine NULLs beside TOTAL."""
    fact = _fact(spark, sf_dir)
    return mart.grouped_average(fact, _dim(spark, sf_dir, fact), ("quality", "toxic"))


# --- scans, cleaning, matching ---------------------------------------------

@register
def scan_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mirror scan: an explicit column list, pruned at the Parquet reader."""
    return tables.read_table(spark, sf_dir, "orders",
                             ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])


@register
def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every string column of documents, and the first number and the second
    line of the text ('' where there is none), with '' turned into NULL."""
    docs = tables.read_table(spark, sf_dir, "documents")
    return tables.blank_strings_to_null(docs.withColumn("first_number", F.regexp_extract("text", "[0-9]+", 0))
                                        .withColumn("second_line", F.regexp_extract("text", "^[^\n]*\n([^\n]*)", 1)))


@register
def schema_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two raw batches with different headers, resolved and concatenated."""
    return inputs.raw_input(spark, sf_dir)


@register
def typed_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw batches typed: trimmed text, safe numbers and dates, name required."""
    return clean.typed_input(inputs.raw_input(spark, sf_dir))


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean.typed_input(inputs.raw_input(spark, sf_dir))
    return match.match_names(typed, inputs.customer_dictionary(spark, sf_dir),
                             match.overrides_frame(spark))


@register
def name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed input matched to the customer dictionary by normalised name."""
    return _matched(spark, sf_dir)


@register
def match_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the match load: total, kept, dropped, output, unmatched, fan-out."""
    return match.match_audit(inputs.raw_input(spark, sf_dir), inputs.customer_dictionary(spark, sf_dir),
                             match.overrides_frame(spark))


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels, and as payload the text's first run of
    anything but letters and spaces: blank, a number, or marks without a
    feature."""
    docs = tables.read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = tables.read_table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").withColumn("payload", F.regexp_extract("text", r"[^\p{L} \n]+", 0))


@register
def validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents whose text passes the validity rule."""
    valid, _ = validate.split(_payloads(spark, sf_dir))
    return valid.select("doc_id", "quality", "toxic",
                        tx.word_count("text").cast("int").alias("n_words"))


@register
def validate_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected payloads: not blank, but without any feature."""
    _, rejected = validate.split(_payloads(spark, sf_dir), text_col="payload")
    return rejected.select("doc_id", "payload")


@register
def validation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads with and without a feature (see ``catalogue_validation_counts``
    for whole texts)."""
    return validate.counts(_payloads(spark, sf_dir), text_col="payload")


@register
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of 500 orders after key 700, in key order."""
    return paging.keyset_page(scan_project(spark, sf_dir), "o_orderkey", after=700, size=500)


@register
def clustered_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same page from orders laid out by key: only the page's files are opened."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/orders-by-key-{uuid.uuid4().hex}"
    paging.write_clustered(scan_project(spark, sf_dir), path, "o_orderkey", file_rows=2000)
    return paging.clustered_page(spark, path, "o_orderkey", after=700, size=500)


# --- fingerprints and sources ------------------------------------------------

@register
def fingerprint_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form (mol_id, bit) of every catalogue entry."""
    return fpo.fingerprint_bits(simplan.valid_molecules(spark, sf_dir))


def word_featuriser():
    """The built-in features as a caller's own function."""
    import regex

    word = regex.compile(r"[\p{L}\p{N}]+")
    return lambda text: word.findall(text.lower())


@register
def featuriser_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints by a Python featuriser, in long form: equal to the built-in ones."""
    return fpo.unpack(featurise.fingerprints(tables.molecules(spark, sf_dir), word_featuriser))


@register
def fingerprint_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bits -> packed words -> 256-byte binary -> words -> bits (lossless)."""
    fps = simplan.catalogue_fingerprints(spark, sf_dir)
    stored = fps.select("mol_id", fpx.to_bytes("fp").alias("fp_bytes"))
    back = stored.select("mol_id", fpx.from_bytes("fp_bytes").alias("fp"))
    return fpo.unpack(back)


@register
def fingerprint_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads (a fragment of each document) with and without a feature; see
    ``catalogue_fingerprint_counts`` for whole texts."""
    mols = _payloads(spark, sf_dir).select("payload")
    return fpo.counts(mols, "payload")


@register
def catalogue_fingerprint_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries fingerprinted vs entries without any feature: whole texts of the
    whole catalogue."""
    return fpo.counts(tables.molecules(spark, sf_dir), "text")


@register
def catalogue_validation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and rejected entries: whole texts of the whole catalogue."""
    return validate.counts(tables.molecules(spark, sf_dir))


@register
def source_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested sources that have a fingerprint, with their bit counts.

    The ids cut the catalogue before any text is read (a valid entry is one
    with a fingerprint)."""
    mols = lookup.found(tables.molecules(spark, sf_dir).select("mol_id", "text"), _requests(spark, sf_dir))
    return fpo.fingerprints(mols).select("mol_id", "n_bits")


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested ids: all benchmark items, and documents of twice a customer's
    number, of which many do not exist."""
    c = tables.read_table(spark, sf_dir, "customer", ["c_custkey"]).withColumn("twice", F.col("c_custkey") * 2)
    return lookup.requested_ids(tables.source_requests(spark, sf_dir).unionByName(c.select(tables.doc_key("twice").alias("mol_id"))))


@register
def source_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested sources without a fingerprint: those not among the valid
    entries, of which only the requested ones are checked."""
    ids = _requests(spark, sf_dir)
    return lookup.missing(ids, validate.split(lookup.found(tables.molecules(spark, sf_dir), ids))[0])


@register
def similarity_all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full score table: every source against every other entry."""
    return simplan.scored(spark, sf_dir)


@register
def similarity_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that score at least 0.2, as float32: the score table as jobs write it."""
    return sim.narrow_scores(simplan.scored(spark, sf_dir, build.LEAST_STORED))


@register
def fingerprint_base64(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints as base64 text, and back to the bit count."""
    text = simplan.catalogue_fingerprints(spark, sf_dir).select("mol_id", fpx.to_base64("fp").alias("b64"))
    return text.select("mol_id", "b64", fpx.popcount_of(fpx.from_base64("b64")).alias("n_bits"))


@register
def key_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page urls as object keys: which match a whole-key pattern, and the number in them."""
    pages = tables.read_table(spark, sf_dir, "pages", ["page_id", "url"])
    return pages.select("page_id", csv_ingest.key_matches("url", r".*/en/[0-9]+\.html$").alias("matches"),
                        F.regexp_extract("url", "/([0-9]+)", 1).cast("long").alias("number"))


# --- files and jobs -----------------------------------------------------------

def _scratch(spark: SparkSession) -> str:
    """A fresh folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/query-{uuid.uuid4().hex}"


def _as_files(batch: DataFrame, root: str, name: str) -> None:
    """A raw batch as CSV files, padding and all, under ``root``/``name``."""
    (batch.drop("_source_file").write.option("header", True).option("escape", '"').option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/{name}"))


def _raw_files(spark: SparkSession, sf_dir: str) -> str:
    root = _scratch(spark)
    _as_files(inputs.orders_batch(spark, sf_dir), f"{root}/in", "batch_01_orders.csv")
    _as_files(inputs.events_batch(spark, sf_dir), f"{root}/in", "batch_02_events.csv")
    return root


def _batch_name(raw: DataFrame) -> DataFrame:
    """The raw columns with the batch's name in place of its files' keys."""
    name = F.concat(F.regexp_extract("_source_file", "(batch_[0-9]+_[a-z]+)", 1), F.lit(".csv"))
    return raw.filter(F.col("_ingested_at").isNotNull()).select(*config.INPUT_COLUMNS, name.alias("_source_file"))


@register
def ingested_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both raw batches written as CSV files, found, read and appended to the raw
    table; a second run of the ingest loads nothing more."""
    root = _raw_files(spark, sf_dir)
    wh = build.Warehouse(spark, f"{root}/wh")
    loaded = build.ingest_input_files(wh, f"{root}/in")
    if not loaded or build.ingest_input_files(wh, f"{root}/in"):
        raise RuntimeError("a file was loaded twice, or none")
    return _batch_name(spark.read.parquet(wh.path(build.RAW_INPUT)))


@register
def streamed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files by the incremental stream, run twice."""
    root = _raw_files(spark, sf_dir)
    for _ in range(2):
        file_ingest.run_once(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint")
    return _batch_name(spark.read.parquet(f"{root}/out"))


@register
def built_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse's jobs in order, from the tables and CSV files to the written
    fact: mirror, molecules, fingerprints, ingest, match, similarity, dimension."""
    root = _scratch(spark)
    for n, (name, batch) in enumerate(inputs.catalogue_batches(spark, sf_dir).items()):
        _as_files(batch, f"{root}/in", f"batch_{n + 3:02d}_{name}.csv")
    wh = build.Warehouse(spark, f"{root}/wh")
    build.run_all(wh, sf_dir, "1", f"{root}/in")
    return wh.read("gold.fact_similarity")


# --- load log -----------------------------------------------------------------

@register
def load_log_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loadlog.current_entries(loadlog.events_as_log(spark, sf_dir))


@register
def load_log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loadlog.latest_version(loadlog.events_as_log(spark, sf_dir))
