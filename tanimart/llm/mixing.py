"""Mixing sources to target weights by Poisson replication.

Each document is repeated Poisson(rate) times, rate = target rows of its
source / rows of its source.  The count comes from inverting the Poisson
distribution at a uniform number hashed from the seed, the document's id and
its text, so a document's count does not depend on partitions, order or other
documents, and documents without an id have draws of their own.
Copies are then dealt to partitions and ordered by a hash: a global shuffle.
Everything runs as DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, save

#: Largest mean inverted at once (exp(-mean) is far from underflow); a higher
#: rate is the sum of several independent Poisson counts of equal mean.
PIECE = 500.0


def _uniform(seed: int, key, piece):
    """52 bits of MD5(seed:piece:key) at the middle of their cell, in (0, 1)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), piece.cast("string"), F.lit(":"), key).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def rates(docs: DataFrame, weights: dict | None, alpha: float, total: float | None, source_col: str = "source") -> DataFrame:
    """(source, rate, pieces, cdf) per source over all documents.  ``weights`` maps
    sources to target shares (others: 0); without it a source's share is its
    count to the power ``alpha``.  ``total``: expected rows (default: as many
    as there are)."""
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        shares = counts.withColumn("share", F.pow("n", F.lit(alpha)))
    else:
        pairs = [F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))]
        table = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
        shares = counts.withColumn("share", F.coalesce(table[F.coalesce("source", F.lit(""))], F.lit(0.0)))
    sums = shares.agg(F.sum("share").alias("shares"), F.sum("n").alias("rows"))
    want = F.lit(float(total)) if total is not None else F.col("rows").cast("double")
    out = shares.crossJoin(F.broadcast(sums)).select(  # sums is one row
        "source", F.when(F.col("shares") > 0, F.col("share") / F.col("shares") * want / F.col("n")).otherwise(0.0).alias("rate"))
    out = out.withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE)).cast("int"))
    return out.withColumn("cdf", poisson_cdf(F.col("rate") / F.col("pieces")))


def poisson_cdf(rate):
    """P(count <= k) for k = 0, 1, ... until the tail is under 2**-53."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    grown = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c")),
        lambda acc, k: F.struct(
            (acc["p"] * rate / k).alias("p"),
            F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + acc["p"] * rate / k)).alias("c")),
    )
    return grown["c"]


def mix(docs: DataFrame, weights: dict | None = None, alpha: float = 0.5, total: float | None = None, seed: int = 17,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Return the columns of ``docs`` plus ``mix_copies`` (the document's
    count), ``mix_copy`` (1 .. count) and ``mix_key`` (its place in the shuffled
    order, a 52-bit integer); rows are dealt to partitions by ``mix_key`` and
    ordered by it inside each.

    Rows are told apart by id and text (``text_col``, if ``docs`` has it): rows
    that share an id, or have none, are drawn one by one as long as their texts
    differ; rows equal in both share their count and are copied each.  A null id
    and a null text hash as empty ones; a null source is a source of its own
    (weight key "").  Columns of these names in ``docs`` are replaced.  An empty
    table gives none.
    """
    docs = docs.drop("mix_copies", "mix_copy", "mix_key")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")) if text_col in docs.columns else F.lit("")
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.col("__text"))
    table = rates(docs, weights, alpha, total, source_col).select(
        F.coalesce("source", F.lit("")).alias("__source"), F.col("source").isNull().alias("__none"),
        F.col("pieces").alias("__pieces"), F.col("cdf").alias("__cdf"))
    counted = (
        docs.withColumn("__text", F.md5(text.cast("binary"))).withColumn("__source", F.coalesce(F.col(source_col), F.lit(""))).withColumn("__none", F.col(source_col).isNull())
        .join(bounded(save(table, "mix-rates"), 20_000), ["__source", "__none"])
        .withColumn("__us", F.transform(F.sequence(F.lit(1), F.col("__pieces")), lambda i: _uniform(seed, key, i)))
        .withColumn("mix_copies", F.aggregate("__us", F.lit(0), lambda n, u: n + F.size(F.filter("__cdf", lambda c: c < u))))
        .drop("__source", "__none", "__pieces", "__cdf", "__us")
        .where("mix_copies > 0")
    )
    copies = counted.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), "mix_copies")))
    place = F.md5(F.concat(F.lit(f"{seed}/"), key, F.lit("/"), F.col("mix_copy").cast("string")).cast("binary"))
    keyed = copies.withColumn("mix_key", F.conv(F.substring(place, 1, 13), 16, 10).cast("long"))
    return keyed.drop("__text").repartition("mix_key").sortWithinPartitions("mix_key")
