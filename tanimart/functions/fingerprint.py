"""Fingerprint expressions: feature hash, packing masks, Tanimoto.

A fingerprint is ``ARRAY<BIGINT>`` of ``config.N_WORDS`` words (layout in
``tanimart.config``).  All expressions are built-in Spark functions, so the
scoring loop stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tanimart import config


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def feature_bit(feature: Column | str) -> Column:
    """Bit position of one feature: first 32 bits of md5, mod the width."""
    prefix = F.substring(F.md5(_col(feature)), 1, config.HASH_HEX_DIGITS)
    return (F.conv(prefix, 16, 10).cast("bigint") % F.lit(config.FINGERPRINT_BITS)).cast("int")


# The word-wise expressions below are written as SQL text: one parse on the
# JVM instead of a few hundred Python->JVM calls per expression.

def word_sql(bit: str) -> str:
    """Index of the word holding bit column ``bit``."""
    return f"shiftright({bit}, 6)"


def mask_sql(bit: str) -> str:
    """Single-bit BIGINT mask of ``bit`` inside its word (MSB first)."""
    return f"shiftleft(1L, {config.WORD_BITS - 1} - ({bit} & {config.WORD_BITS - 1}))"


def popcount_sql(fp: str) -> str:
    return " + ".join(f"bit_count({fp}[{i}])" for i in range(config.N_WORDS))


def popcount(fp: str) -> Column:
    """Number of on bits of a packed fingerprint column ``fp``."""
    return F.expr(popcount_sql(fp))


def popcount_of(fp: Column) -> Column:
    """Number of on bits of a fingerprint expression."""
    return F.aggregate(fp, F.lit(0), lambda n, w: n + F.bit_count(w))


def common_bits_sql(a: str, b: str) -> str:
    return " + ".join(f"bit_count({a}[{i}] & {b}[{i}])" for i in range(config.N_WORDS))


def common_bits(a: str, b: str) -> Column:
    """|A AND B| for two packed fingerprint columns (32 ANDs + popcounts)."""
    return F.expr(common_bits_sql(a, b))


def common_bits_walk(a: str, b: str) -> Column:
    """|A AND B| as a walk over both arrays.

    For joins: the unrolled sum inside a join's loop makes a method that the
    JIT compiler declines, and a pair then costs ten times as much."""
    both = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y)))
    return F.aggregate(both, F.lit(0), lambda n, c: n + c)


def tanimoto(a: str, a_pop: str, b: str, b_pop: str) -> Column:
    """|A AND B| / |A OR B| as double; 0.0 when both fingerprints are empty.

    Single-expression form (for small inputs and tests); the scoring
    operator computes the intersection once and calls
    ``tanimoto_from_counts``.
    """
    return tanimoto_from_counts(common_bits(a, b), a_pop, b_pop)


def tanimoto_from_counts(n_common: Column | str, a_pop: Column | str, b_pop: Column | str) -> Column:
    """Tanimoto from |A AND B|, |A| and |B|; 0.0 when the union is empty."""
    inter = _col(n_common)
    union = _col(a_pop) + _col(b_pop) - inter
    return F.when(union == 0, F.lit(0.0)).otherwise(inter.cast("double") / union.cast("double"))


# Bytes <-> words are export/import paths, not the scoring loop: they are
# written as array lambdas so the generated code stays small next to the
# pack aggregate.

def to_bytes(fp: str) -> Column:
    """Packed words -> 256-byte MSB-first BINARY (the stored exchange form)."""
    return F.expr(f"unhex(concat_ws('', transform({fp}, w -> lpad(hex(w), 16, '0'))))")


def from_bytes(raw: str) -> Column:
    """256-byte BINARY -> packed words; any other length raises."""
    n_bytes = config.FINGERPRINT_BITS // 8
    words = (f"transform(sequence(0, {config.N_WORDS - 1}), "
             f"i -> CAST(conv(hex(substring({raw}, i * 8 + 1, 8)), 16, -10) AS BIGINT))")
    return F.expr(
        f"CASE WHEN length({raw}) = {n_bytes} THEN {words} "
        f"ELSE CAST(raise_error(concat('fingerprint must be {n_bytes} bytes, got ', "
        f"CAST(length({raw}) AS STRING))) AS ARRAY<BIGINT>) END")


def to_base64(fp: str) -> Column:
    """Packed words -> base64 text of the 256 bytes (for text-only channels).

    One line: Spark may wrap base64 output at 76 characters, so line breaks
    are removed.
    """
    return F.regexp_replace(F.base64(to_bytes(fp)), "[\\r\\n]", "")


def from_base64(text: str) -> Column:
    """Base64 text of 256 bytes -> packed words (length checked)."""
    return from_bytes(f"unbase64({text})")
