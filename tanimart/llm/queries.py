"""Registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import ann, chat, decontam, fim, mixing, ngram_join, packing, quality, sharding, suffix_dedup, url_filter, warc, whitening
from .common import fresh_path, read

#: Fixed rules of the URL filter: host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a record per page, index the archives, look every page's key up
    and read its records back by range."""
    pages = read(spark, sf_dir, "pages")
    root = fresh_path(spark, "warc")
    captures = warc.write_archives(pages, root)
    index = warc.build_index(captures, root)
    key = F.udf(warc.reversed_host_key, StringType())
    keys = pages.select(key(F.col("url").cast("string")).alias("key"))
    found = warc.fetch(warc.lookup(keys, index, root), root)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op2_decontaminate_cgk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that match."""
    return decontam.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_ann_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every vector whose id is divisible by 20."""
    vectors = read(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op4_mix_poisson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed so that a source's share is the square root of its count."""
    return mixing.mix(read(spark, sf_dir, "documents"))


def op5_shard_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 16 shards of equal bytes."""
    return sharding.shard(read(spark, sf_dir, "documents"), 16)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to 100-byte strings that start earlier."""
    return suffix_dedup.deduplicate(read(spark, sf_dir, "documents"))


def op7_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's perspective."""
    return chat.perspectives(read(spark, sf_dir, "conversations"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component under links of Jaccard 0.9 on 3-word shingles."""
    return ngram_join.join(read(spark, sf_dir, "documents"), 3, 90, 100)


#: Documents whose id has this remainder are held out of every fit.
HELD_OUT = "pmod(crc32(cast(coalesce(cast({0} as string), '') as binary)), 5) = 0"
#: Least score that counts as label 1.
QUALITY_LEAST = 0.3


def quality_model(spark: SparkSession, sf_dir: str):
    """Model fitted on the labelled documents that are not held out."""
    labels = read(spark, sf_dir, "labels").where(~F.expr(HELD_OUT.format("doc_id"))).select("doc_id", "quality")
    return quality.train(read(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id"))


def op9_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    scored = quality.score(read(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    return scored.select(
        "doc_id", F.expr(HELD_OUT.format("doc_id")).alias("held_out"), "score", (F.col("score") >= QUALITY_LEAST).cast("int").alias("predicted"))


def op10_url_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the rules and its aliases."""
    return url_filter.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op11_whiten_cholesky_qr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on its 16 whitening components."""
    rows = whitening.whiten(read(spark, sf_dir, "embeddings"), 16)
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_fim_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fill-in-middle form, and the text rebuilt from it."""
    out = fim.transform(read(spark, sf_dir, "documents"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("fim_text")).alias("output_sha256"),
                      sha(fim.restored("fim_text", "form")).alias("restored_sha256"))


def op13_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of 1024 tokens.

    The checksum is taken from the written ids, which stay where they are."""
    table = packing.pieces(read(spark, sf_dir, "documents"), capacity=1024)
    slim = table.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(slim, 1024).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_warc_index, op2_decontaminate_cgk, op3_ann_collisions, op4_mix_poisson, op5_shard_splitters, op6_suffix_dedup, op7_chat_perspectives, op8_ngram_join, op9_quality_nbsvm, op10_url_equivalence, op11_whiten_cholesky_qr, op12_fim_wavelet, op13_pack_best_fit)
}
