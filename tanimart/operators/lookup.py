"""Source lookup: which requested ids have an entry, which do not.

All joins here are left to AQE, which broadcasts the ids when their runtime
size allows and shuffles (splitting skewed keys) otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def requested_ids(requests: DataFrame, id_col: str = "mol_id") -> DataFrame:
    """Distinct non-NULL requested ids."""
    return requests.select(F.col(id_col).alias("mol_id")).filter(F.col("mol_id").isNotNull()).distinct()


def found(entries: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``entries`` whose id was requested (semi join).

    Join the catalogue itself, then fingerprint what is left: only requested
    texts are tokenised."""
    return entries.join(ids.select("mol_id"), "mol_id", "left_semi")


def missing(ids: DataFrame, entries: DataFrame) -> DataFrame:
    """Requested ids without an entry (anti join)."""
    return ids.select("mol_id").join(entries.select("mol_id"), "mol_id", "left_anti")
