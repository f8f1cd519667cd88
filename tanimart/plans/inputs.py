"""Raw input batches rendered from the given tables.

The warehouse's input arrives as loosely formatted text batches.  Here two
batches are derived from ``orders`` and ``events``: every value is rendered
as text, names refer to the customer dictionary in varying case and
padding, and the two batches use different headers (padded names, aliases,
different column subsets) -- the same shapes the CSV loader resolves.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tanimart.sources import csv_ingest, tables


def _customer_ref(key: str) -> F.Column:
    return F.concat(F.lit("customer#"), F.lpad(F.col(key).cast("string"), 9, "0"))


def orders_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a raw batch with padded header names."""
    o = tables.read_table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("compound_id"),
        F.upper(F.concat(F.lit("  "), _customer_ref("o_custkey"), F.lit(" "))).alias(" compound_name"),
        F.col("o_totalprice").cast("string").alias("molecular_weight "),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("assay_date"),
        F.col("o_orderpriority").alias("lab_id"),
        F.lit("batch_01_orders.csv").alias("_source_file"),
    )


def events_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a raw batch using the aliased header names.

    The event type decides how careless the row is: a name with an override, a
    blank name, an unknown name, a number with a type suffix, other date forms.
    """
    e = tables.read_table(spark, sf_dir, "events")
    kind, number = F.col("event_type"), F.regexp_extract("props", "([0-9]+)", 1)
    return e.select(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("compound_id"),
        F.when(kind == "error", F.lit(" Paracetamol")).when(kind == "signup", F.lit("  "))
        .when(kind == "click", F.concat(F.lit("unknown "), F.col("user_id").cast("string")))
        .otherwise(_customer_ref("user_id")).alias("compound_name"),
        F.col("value").cast("string").alias("logp"),
        F.when(kind == "click", F.concat(number, F.lit("f"))).otherwise(number).alias("IC50_nM"),
        F.when(kind == "view", F.date_format("ts", "MM/dd/yyyy")).when(kind == "error", F.date_format("ts", "yyyyMMdd"))
        .when(kind == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("ts", "yyyy-M-d")).alias("collection_date"),
        F.col("event_type").alias("lab_id"),
        F.lit("batch_02_events.csv").alias("_source_file"),
    )


def raw_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches, headers resolved, concatenated by name (all text)."""
    return csv_ingest.union_batches([csv_ingest.align(orders_batch(spark, sf_dir)),
                                     csv_ingest.align(events_batch(spark, sf_dir))])


#: Entries of the name dictionary besides the customers: one name twice, so
#: rows that match it fan out to two.
EXTRA_NAMES = [("Acetaminophen", -1), ("ACETAMINOPHEN", -2)]


def customer_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name dictionary: (name, matched_id)."""
    c = tables.read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    return (c.select(F.col("c_name").alias("name"), F.col("c_custkey").cast("long").alias("matched_id"))
            .unionByName(spark.createDataFrame(pa.table({"name": [n for n, _ in EXTRA_NAMES], "matched_id": [i for _, i in EXTRA_NAMES]}))))


def _numbered(prefix: str, key: str) -> F.Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), 9, "0"))


def catalogue_batches(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw batches that name catalogue entries: suppliers refer to benchmark
    items (many to none that exists), nations to documents."""
    s = tables.read_table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("compound_id"),
        F.upper(_numbered(" item#", "s_suppkey")).alias(" compound_name"), F.col("s_acctbal").cast("string").alias("molecular_weight"),
        F.lit("batch_03_suppliers.csv").alias("_source_file"))
    n = tables.read_table(spark, sf_dir, "nation").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("compound_id"),
        _numbered("Document#", "n_nationkey").alias("compound_name"), F.lit("batch_04_nations.csv").alias("_source_file"))
    return {"suppliers": s, "nations": n}


def catalogue_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both of them, headers resolved, concatenated by name."""
    return csv_ingest.union_batches([csv_ingest.align(b) for b in catalogue_batches(spark, sf_dir).values()])


def catalogue_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the catalogue's entries: (name, matched_id = mol_id)."""
    docs = tables.read_table(spark, sf_dir, "documents", ["doc_id"])
    items = tables.read_table(spark, sf_dir, "benchmark", ["item_id"])
    return (docs.select(_numbered("document#", "doc_id").alias("name"), tables.doc_key("doc_id").alias("matched_id"))
            .unionByName(items.select(_numbered("item#", "item_id").alias("name"), tables.bench_key("item_id").alias("matched_id"))))
