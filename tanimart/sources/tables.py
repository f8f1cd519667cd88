"""Scans of the warehouse's input tables.

Every read names its columns, so Catalyst prunes the Parquet scan to them
(``ReadSchema`` in the plan) and pushes any later filter into the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Table registry: table -> columns read from it.  A column list per table is
# the whole configuration of the mirror step; nothing else is read.
TABLE_COLUMNS: dict[str, list[str]] = {
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "embeddings": ["vec_id", "embedding", "label"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
               "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                 "l_linestatus", "l_shipdate"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "region": ["r_regionkey", "r_name"],
    "pages": ["page_id", "url", "html"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Scan one table with an explicit column list (registry default)."""
    cols = columns or TABLE_COLUMNS[name]
    return spark.read.parquet(table_path(sf_dir, name)).select(*cols)


def blank_strings_to_null(df: DataFrame) -> DataFrame:
    """'' -> NULL in every string column, other columns untouched."""
    out = []
    for field in df.schema.fields:
        if field.dataType.simpleString() == "string":
            out.append(F.nullif(F.col(field.name), F.lit("")).alias(field.name))
        else:
            out.append(F.col(field.name))
    return df.select(*out)


# --- the similarity catalogue ----------------------------------------------
# Documents stand for catalogue entries (structure = text); benchmark items are
# the query set and are catalogue members too, so a source can be looked up in
# the fingerprint table and its own entry is excluded from its neighbours.

DOC_PREFIX = "D"
BENCH_PREFIX = "B"


def doc_key(c) -> F.Column:
    return F.concat(F.lit(DOC_PREFIX), F.col(c).cast("string"))


def bench_key(c) -> F.Column:
    return F.concat(F.lit(BENCH_PREFIX), F.col(c).cast("string"))


def molecules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue: mol_id, kind, text, lang, source, n_chars (one row per entry)."""
    docs = read_table(spark, sf_dir, "documents")
    docs = docs.select(
        doc_key("doc_id").alias("mol_id"),
        F.lit("document").alias("kind"),
        "text", "lang", "source", "n_chars",
    )
    bench = read_table(spark, sf_dir, "benchmark").select(
        bench_key("item_id").alias("mol_id"),
        F.lit("benchmark").alias("kind"),
        "text",
        F.lit(None).cast("string").alias("lang"),
        F.lit(None).cast("string").alias("source"),
        F.length("text").cast("bigint").alias("n_chars"),
    )
    return docs.unionByName(bench)


def source_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requested source ids (the input set): one row per benchmark item."""
    return read_table(spark, sf_dir, "benchmark", ["item_id"]).select(
        bench_key("item_id").alias("mol_id"))


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-entry properties (partial cover): mol_id, quality, toxic."""
    return read_table(spark, sf_dir, "labels").select(
        doc_key("doc_id").alias("mol_id"), "quality", "toxic")
