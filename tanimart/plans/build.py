"""Warehouse jobs: each layer is built from the previous one and written.

Writes happen only here.  Every build is version-gated through the load
log (skip when the wanted version is already built, ``force`` rebuilds),
publishes atomically (see ``sources.sinks.replace``), and records its row
count.  Intermediate results are written tables, so each job starts from
files, not from a long lineage, and a lost executor only re-runs tasks of
the current job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tanimart import config
from tanimart.functions import text as tx
from tanimart.operators import clean, lookup, match, validate
from tanimart.operators import fingerprints as fpo
from tanimart.operators import similarity as sim
from tanimart.plans import loadlog, mart
from tanimart.session import materialize
from tanimart.sources import csv_ingest, relational, sinks, tables

# Bronze mirror registry: bronze table -> (source table, columns read).
MIRROR: dict[str, tuple[str, list[str]]] = {
    "bronze.documents": ("documents", tables.TABLE_COLUMNS["documents"]),
    "bronze.benchmark": ("benchmark", tables.TABLE_COLUMNS["benchmark"]),
    "bronze.labels": ("labels", tables.TABLE_COLUMNS["labels"]),
}


@dataclass
class BuildResult:
    table: str
    version: str
    skipped: bool
    rows: int | None


class Warehouse:
    """Tables under one root folder on shared storage, plus the load log."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- layout --------------------------------------------------------------
    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def read(self, table: str) -> DataFrame:
        return sinks.read_current(self.spark, self.path(table))

    @property
    def log_path(self) -> str:
        return self.path("meta.load_log")

    # -- load log (append-only; newest row wins) -------------------------------
    def log(self) -> DataFrame:
        if not sinks.exists(self.spark, self.log_path):
            return self.spark.createDataFrame([], loadlog.LOG_SCHEMA)
        return self.spark.read.schema(loadlog.LOG_SCHEMA).parquet(self.log_path)

    def record(self, *rows: tuple[str, str, int]) -> None:
        """Append (table, version, row count) rows in one write."""
        sinks.append(loadlog.log_rows(self.spark, list(rows)).coalesce(1), self.log_path)

    def last_version(self, table: str) -> str | None:
        """Version of the newest log row for ``table`` (one aggregated row)."""
        row = (loadlog.latest_version(self.log().filter(F.col("table_name") == table))
               .select("version").first())
        return row[0] if row else None

    # -- gated build -------------------------------------------------------------
    def build(self, table: str, version: str, make, force: bool = False,
              require_rows: bool = False, also=lambda: [], **write_opts) -> BuildResult:
        """Build ``table`` from ``make()`` unless ``version`` is already built.

        ``also`` gives further log rows once the table is written: counts that
        were observed on the write's own job."""
        if not force and self.last_version(table) == version:
            return BuildResult(table, version, True, None)
        rows = sinks.replace(make(), self.path(table), require_rows=require_rows, **write_opts)
        self.record((table, version, rows), *also())
        return BuildResult(table, version, False, rows)


# --- bronze -------------------------------------------------------------------

def mirror_tables(wh: Warehouse, sf_dir: str, version: str, force: bool = False) -> list[BuildResult]:
    """Copy each registered source table (its columns only), '' -> NULL.

    ``sf_dir`` is a folder of Parquet tables or one relational file (.db,
    .sqlite, .sqlite3)."""
    relational_file = sf_dir.endswith((".db", ".sqlite", ".sqlite3"))
    out = []
    for target, (source, cols) in MIRROR.items():
        def make(source=source, cols=cols):
            rows = (relational.read_relational(wh.spark, sf_dir, source, cols) if relational_file
                    else tables.read_table(wh.spark, sf_dir, source, cols))
            return tables.blank_strings_to_null(rows)
        out.append(wh.build(target, version, make, force=force))
    return out


RAW_INPUT = "bronze.raw_input"

# Scores below this are not stored in the score table unless asked for.
LEAST_STORED = 0.2


def ingest_input_files(wh: Warehouse, input_root: str) -> list[str]:
    """Load batch files not loaded before; returns the files loaded.

    Discovery matches the whole key against the pattern; every file's header
    is resolved before any data is written (a bad header fails the run and
    writes nothing); each file is logged with its key as the version, so a
    re-run loads nothing twice, and each file's rows live in their own
    partition, so even a re-load after a crash replaces rather than appends.
    """
    spark = wh.spark
    files = csv_ingest.list_batch_files(spark, input_root)
    if not files:
        return []
    # Diff against the log in Spark: only the new names (bounded by the
    # listing) come back, never the whole history of loaded keys.
    listed = spark.createDataFrame([(f,) for f in files], "version string")
    loaded = wh.log().filter(F.col("table_name") == RAW_INPUT).select("version")
    new = sorted(r[0] for r in listed.join(loaded, "version", "left_anti").collect())
    if not new:
        return []
    batch = (csv_ingest.read_batches(spark, new)  # headers checked here
             .withColumn("_ingested_at", F.current_timestamp())
             .withColumn("_file_id", F.substring(F.sha2("_source_file", 256), 1, 16)))
    # One partition per file, replaced dynamically: if a run dies after the
    # write but before the log rows, the re-run rewrites the same partitions
    # instead of appending the rows a second time.
    sinks.overwrite_partitions(batch, wh.path(RAW_INPUT), ["_file_id"])
    keys = spark.createDataFrame([(f, csv_ingest.file_key(spark, f)) for f in new], "version string, _source_file string")
    # only the partitions just written are read again
    own = F.substring(F.sha2(F.col("_source_file"), 256), 1, 16)
    ids = [r[0] for r in keys.select(own).collect()]
    written = spark.read.parquet(wh.path(RAW_INPUT)).where(F.col("_file_id").isin(ids)).select("_source_file")
    counts = (keys.join(written.withColumn("_row", F.lit(1)), "_source_file", "left").groupBy("version")
              .agg(F.count("_row").alias("n")))
    wh.record(*[(RAW_INPUT, r.version, r.n) for r in counts.collect()])
    return new


# --- silver -------------------------------------------------------------------

def build_molecules(wh: Warehouse, version: str, force: bool = False) -> BuildResult:
    """Catalogue entries (documents + benchmark items) whose text is valid.

    Ids must be unique.  The log also gets the rejected entries' number."""
    docs = wh.read("bronze.documents").select(tables.doc_key("doc_id").alias("mol_id"), "text")
    bench = wh.read("bronze.benchmark").select(tables.bench_key("item_id").alias("mol_id"), "text")
    entries = docs.unionByName(bench)
    seen = Observation(f"molecules_{version}")
    out = wh.build("silver.molecule", version, lambda: validate.split(fpo.require_unique(entries), seen=seen)[0], force=force,
                   also=lambda: [("silver.molecule.rejected", version, seen.get["rejected_rows"])])
    return out


def build_fingerprints(wh: Warehouse, version: str, force: bool = False) -> BuildResult:
    """Packed fingerprints, files of at most BATCH_ROWS rows, sorted by id;
    the log also gets the number of entries without one."""
    molecules = wh.read("silver.molecule")
    failed = Observation(f"fingerprints_{version}")
    return wh.build("silver.fingerprint", version, lambda: fpo.fingerprints(molecules, failed=failed),
                    force=force, max_records_per_file=config.BATCH_ROWS, sort_within=["mol_id"],
                    also=lambda: [("silver.fingerprint.failed", version, failed.get["failed_rows"])])


def catalogue_names(wh: Warehouse) -> DataFrame:
    """Name dictionary of the catalogue: (name, matched_id = mol_id)."""
    numbered = lambda prefix, key: F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), 9, "0"))
    docs = wh.read("bronze.documents").select(numbered("document#", "doc_id").alias("name"), tables.doc_key("doc_id").alias("matched_id"))
    items = wh.read("bronze.benchmark").select(numbered("item#", "item_id").alias("name"), tables.bench_key("item_id").alias("matched_id"))
    return docs.unionByName(items)


def build_matched_input(wh: Warehouse, dictionary: DataFrame | None = None) -> int:
    """Typed input matched to the catalogue's names; always rebuilt from the raw input.

    The log gets what the job itself observed: rows without a name (dropped),
    rows that match no entry, and extra rows of names with several entries."""
    raw = wh.spark.read.parquet(wh.path(RAW_INPUT))
    names = catalogue_names(wh) if dictionary is None else dictionary
    read, out = Observation("input_read"), Observation("input_matched")
    kept = F.coalesce(tx.is_present("compound_name"), F.lit(False))
    raw = raw.observe(read, F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"))
    matched = match.match_names(clean.typed_input(raw), names, match.overrides_frame(wh.spark))
    matched = matched.observe(out, F.count_if(F.col("matched_id").isNull()).alias("unmatched"))
    rows = sinks.replace(matched, wh.path("silver.matched_input"))
    version = sinks.current_path(wh.spark, wh.path("silver.matched_input")).rsplit("/", 1)[1]
    counts = {"dropped": read.get["dropped"], "unmatched": out.get["unmatched"], "fanout": rows - read.get["kept"]}
    wh.record(("silver.matched_input", version, rows), *((f"silver.matched_input.{k}", version, n) for k, n in counts.items()))
    return rows


# --- gold ---------------------------------------------------------------------

def build_similarity(wh: Warehouse, version: str, force: bool = False, n: int = config.TOP_N,
                     store_from: float | None = None, changed: bool = False) -> BuildResult:
    """The top-N fact of the sources that the matched input refers to.

    Refuses to run when the input matches no entry.  With ``changed`` an earlier
    result is brought up to date, with ``force`` all is scored again.  With
    ``store_from`` the pairs that score at least that are stored too (0 stores
    all of them)."""
    if not force and not changed and wh.last_version("gold.fact_similarity") == version:
        return BuildResult("gold.fact_similarity", version, True, None)
    if sinks.current_path(wh.spark, wh.path("silver.matched_input")) is None:
        raise sinks.EmptyResult("no input was matched yet: give the input folder once")
    fps = wh.read("silver.fingerprint")
    sources = materialize(lookup.found(fps, lookup.requested_ids(wh.read("silver.matched_input"), "matched_id")))
    if sources.isEmpty():
        raise sinks.EmptyResult("the matched input refers to no entry with a fingerprint")
    if store_from is not None:
        sinks.replace(sim.score_pairs(sources, fps, least=store_from), wh.path("gold.similarity"))
    keep_head(wh, sources, fps, n, anew=force)
    rows = sinks.replace(sim.flagged(wh.read(HEAD), n), wh.path("gold.fact_similarity"), require_rows=True)
    wh.record(("gold.fact_similarity", version, rows))
    return BuildResult("gold.fact_similarity", version, False, rows)


HEAD = "gold.similarity_head"


def keep_head(wh: Warehouse, sources: DataFrame, fps: DataFrame, n: int, anew: bool = False) -> None:
    """Bring the stored first ``n`` + 1 rows per source up to date.

    The log tells which fingerprint table they were made from; from there only
    what changed is scored (see ``similarity.maintained``).  They are made anew
    where there are none, where they hold another number of rows, or where that
    fingerprint table is gone."""
    basis = sinks.current_path(wh.spark, wh.path("silver.fingerprint"))
    last = wh.last_version(HEAD)
    before, _, rows = last.rpartition("#") if last else ("", "", "")
    if anew or not before or rows != str(n) or not sinks.exists(wh.spark, before):
        head = sim.head(sources, fps, n)
    elif before == basis:
        nothing = fps.limit(0)
        head = sim.maintained(wh.read(HEAD), sources, fps, nothing.select("mol_id"), nothing, n)
    else:
        head = sim.maintained(wh.read(HEAD), sources, fps, *sim.changes(wh.spark.read.parquet(before), fps), n)
    wh.record((HEAD, f"{basis}#{n}", sinks.replace(head, wh.path(HEAD))))


def build_dimension(wh: Warehouse, version: str, force: bool = False) -> BuildResult:
    """Dimension scoped to the fact; refuses to run on an empty fact."""
    def make():
        fact = wh.read("gold.fact_similarity")
        if fact.isEmpty():
            raise sinks.EmptyResult("fact is empty; dimension not rebuilt")
        docs = wh.read("bronze.documents")
        bench = wh.read("bronze.benchmark")
        molecules = docs.select(tables.doc_key("doc_id").alias("mol_id"), F.lit("document").alias("kind"),
                                "text", "lang", "n_chars").unionByName(
            bench.select(tables.bench_key("item_id").alias("mol_id"), F.lit("benchmark").alias("kind"),
                         "text", F.lit(None).cast("string").alias("lang"),
                         F.length("text").cast("bigint").alias("n_chars")))
        props = wh.read("bronze.labels").select(tables.doc_key("doc_id").alias("mol_id"), "quality", "toxic")
        return mart.dimension(fact, molecules, props)
    return wh.build("gold.dim_molecule", version, make, force=force, require_rows=True)


def register_views(wh: Warehouse) -> list[str]:
    """Expose the fact, the dimension and the five views as temp views."""
    fact, dim = wh.read("gold.fact_similarity"), wh.read("gold.dim_molecule")
    views = {
        "fact_similarity": fact,
        "dim_molecule": dim,
        "average_similarity_score": mart.average_per_source(fact),
        "similarity_property_deviation": mart.property_deviation(fact, dim),
        "similarity_pivot_sources": mart.pivot_sources(fact),
        "similarity_neighbor_chain": mart.neighbor_chain(fact),
        "average_similarity_grouped": mart.grouped_average(fact, dim),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def expire(wh: Warehouse, keep: int = 2) -> list[str]:
    """Remove replaced versions of all tables but the ``keep`` newest of each.

    The fingerprints that the stored head was made from stay: the next upkeep
    compares with them.  Run it when no build and no long reader is at work."""
    last = wh.last_version(HEAD)
    spare = (last.rpartition("#")[0],) if last else ()
    names = {r.table_name for r in wh.log().select("table_name").distinct().collect()} | {"gold.similarity"}
    return [folder for t in sorted(names) for folder in sinks.expire(wh.spark, wh.path(t), keep, spare)]


def run_all(wh: Warehouse, sf_dir: str, version: str, input_root: str | None = None,
            force: bool = False) -> dict[str, BuildResult | int | list]:
    """The whole chain in dependency order (what a scheduler would order)."""
    out: dict = {"mirror": mirror_tables(wh, sf_dir, version, force)}
    out["molecule"] = build_molecules(wh, version, force)
    out["fingerprint"] = build_fingerprints(wh, version, force or not out["molecule"].skipped)
    changed = not out["fingerprint"].skipped
    if input_root:
        out["ingest"] = ingest_input_files(wh, input_root)
        out["matched"] = build_matched_input(wh)
        changed = changed or bool(out["ingest"])
    out["similarity"] = build_similarity(wh, version, force, changed=changed)
    out["dimension"] = build_dimension(wh, version, force or not out["similarity"].skipped)
    return out
