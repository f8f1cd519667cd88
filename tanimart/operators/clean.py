"""Silver typing of raw text input: trim, safe casts, required-name filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tanimart.functions import text as tx


def typed_input(raw: DataFrame) -> DataFrame:
    """Raw all-text input -> typed rows; rows without a name are dropped.

    molecular_weight and ic50_nm must be positive (else NULL); logp may be
    any number; text that is not a number or a date becomes NULL.
    """
    return raw.filter(tx.is_present("compound_name")).select(
        F.trim("compound_id").alias("compound_id"),
        F.trim("compound_name").alias("compound_name"),
        tx.positive_or_null(tx.safe_number("molecular_weight")).alias("molecular_weight"),
        tx.safe_number("logp").alias("logp"),
        tx.positive_or_null(tx.safe_number("ic50_nm")).alias("ic50_nm"),
        tx.safe_date("assay_date").alias("assay_date"),
        F.trim("lab_id").alias("lab_id"),
        "_source_file",
    )
