"""Fingerprint jobs: features -> bits -> packed words, and back.

All features of an entry are in its row, so an entry is hashed and packed
where it lies: no stage here shuffles, and two rows with one id stay two rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tanimart import config
from tanimart.functions import fingerprint as fpx
from tanimart.functions import text as tx


def feature_bits(text: str, features: Column | None = None) -> Column:
    """Sorted distinct bit positions of a row's features.

    ``features`` is any ARRAY<STRING> expression; by default the words of
    ``text``.  NULL elements and '' are no features.
    """
    own = tx.tokens(text) if features is None else F.filter(features, lambda f: f.isNotNull() & (f != ""))
    return F.array_sort(F.array_distinct(F.transform(F.array_distinct(own), fpx.feature_bit)))


def fingerprint_bits(df: DataFrame, id_col: str = "mol_id", text_col: str = "text",
                     features: Column | None = None) -> DataFrame:
    """Long form: distinct (mol_id, bit).  Entries without features vanish.

    The outer form: a plain ``explode`` is given a filter on the array's size,
    and that filter would hash every text once more."""
    bits = df.select(F.col(id_col).alias("mol_id"), F.explode_outer(feature_bits(text_col, features)).alias("bit"))
    return bits.filter(F.col("bit").isNotNull())


def _packed(bits: str) -> Column:
    """Sorted bit positions -> words, in one walk over the array.

    The walk keeps the word under construction; when a bit belongs to a later
    word, the finished one and the empty ones between are appended.
    """
    start = "named_struct('at', 0, 'word', 0L, 'done', CAST(array() AS ARRAY<BIGINT>))"
    at, mask = fpx.word_sql("b"), fpx.mask_sql("b")
    step = (f"IF({at} = a.at, named_struct('at', a.at, 'word', a.word | {mask}, 'done', a.done), "
            f"named_struct('at', {at}, 'word', {mask}, 'done', "
            f"concat(a.done, array(a.word), array_repeat(0L, {at} - a.at - 1))))")
    end = f"concat(a.done, array(a.word), array_repeat(0L, {config.N_WORDS - 1} - a.at))"
    return F.expr(f"aggregate({bits}, {start}, (a, b) -> {step}, a -> {end})")


def fingerprints(df: DataFrame, id_col: str = "mol_id", text_col: str = "text",
                 features: Column | None = None, failed: Observation | None = None) -> DataFrame:
    """(mol_id, fp ARRAY<BIGINT>(32), n_bits) for entries with >= 1 feature.

    ``failed`` observes ``failed_rows``, the entries without one, on the job
    that reads the result."""
    bits = tx.once(df, "_bits", feature_bits(text_col, features)).select(F.col(id_col).alias("mol_id"), "_bits")
    if failed is not None:
        bits = bits.observe(failed, F.count_if(F.coalesce(F.size("_bits"), F.lit(0)) <= 0).alias("failed_rows"))
    return (bits.filter(F.size("_bits") > 0)
            .select("mol_id", _packed("_bits").alias("fp"), F.size("_bits").alias("n_bits")))


def pack_bits(bits: DataFrame) -> DataFrame:
    """Long form (mol_id, bit) -> packed (mol_id, fp, n_bits).

    The rows of an entry are gathered first (at most FINGERPRINT_BITS
    distinct positions each)."""
    rows = bits.groupBy("mol_id").agg(F.array_sort(F.collect_set("bit")).alias("_bits"))
    return rows.select("mol_id", _packed("_bits").alias("fp"), F.size("_bits").alias("n_bits"))


def unpack(fps: DataFrame) -> DataFrame:
    """Packed -> long form (mol_id, bit); exact inverse of ``pack_bits``.

    Generators only (no per-element lambdas): non-zero words are exploded
    with their index, then each word's 64-character binary string (MSB
    first, matching the layout) with the character position.  Outer forms, so
    that no filter on an array's size evaluates it twice.
    """
    words = fps.select("mol_id", F.posexplode_outer("fp").alias("word", "w")).filter(F.col("w") != 0)
    chars = words.select("mol_id", "word",
                         F.posexplode_outer(F.split(F.lpad(F.bin("w"), config.WORD_BITS, "0"), "")).alias("pos", "c"))
    return (chars.filter(F.col("c") == "1")
            .select("mol_id", (F.col("word") * config.WORD_BITS + F.col("pos")).cast("int").alias("bit")))


def failed_entries(df: DataFrame, text_col: str = "text", features: Column | None = None) -> DataFrame:
    """Entries that produce no fingerprint (no feature)."""
    return df.filter(F.coalesce(F.size(feature_bits(text_col, features)), F.lit(0)) <= 0)


def counts(df: DataFrame, text_col: str = "text", features: Column | None = None) -> DataFrame:
    """(succeeded_rows, failed_rows) of a fingerprint run: one pass, nothing hashed."""
    own = tx.tokens(text_col) if features is None else features
    some = F.coalesce(F.exists(own, lambda f: f != ""), F.lit(False))
    return df.agg(F.count_if(some).alias("succeeded_rows"), F.count_if(~some).alias("failed_rows"))


class DuplicateId(ValueError):
    """An id that must be unique occurs more than once."""


def require_unique(df: DataFrame, id_col: str = "mol_id") -> DataFrame:
    """``df`` itself, or an error that names some ids that occur twice."""
    twice = df.groupBy(id_col).count().filter("count > 1").limit(5).collect()
    if twice:
        raise DuplicateId(f"{id_col} is not unique: {[r[0] for r in twice]}")
    return df
