"""Validate-and-split: a boolean rule column decides which rows go on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tanimart.functions import text as tx


def default_rule(text_col: str = "text") -> Column:
    """A structure string is valid when it yields at least one feature (else
    it has no fingerprint).  The one rule of queries, jobs and the chain."""
    return F.exists(tx.tokens(text_col), lambda t: t != F.lit(""))


def with_validity(df: DataFrame, rule: Column, text_col: str = "text") -> DataFrame:
    """Rows with ``is_valid``: NULL where the text is blank, else the rule (its
    NULL is False).  The rule is evaluated once per row, above the joins that
    cut ``df`` by its other columns."""
    return tx.once(df, "is_valid", F.when(tx.is_present(text_col), F.coalesce(rule, F.lit(False))))


def split(df: DataFrame, rule: Column | None = None, text_col: str = "text",
          seen: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) frames over one lazily shared input; blank rows are in neither.

    ``seen`` observes ``valid_rows`` and ``rejected_rows`` on the job that
    reads one of the frames."""
    flagged = with_validity(df, rule if rule is not None else default_rule(text_col), text_col)
    if seen is not None:
        flagged = flagged.observe(seen, F.count_if("is_valid").alias("valid_rows"), F.count_if(~F.col("is_valid")).alias("rejected_rows"))
    return flagged.filter("is_valid").drop("is_valid"), flagged.filter(~F.col("is_valid")).drop("is_valid")


def counts(df: DataFrame, rule: Column | None = None, text_col: str = "text") -> DataFrame:
    """(valid_rows, rejected_rows) in one aggregate."""
    flagged = with_validity(df, rule if rule is not None else default_rule(text_col), text_col)
    return flagged.agg(F.count_if("is_valid").alias("valid_rows"),
                       F.count_if(~F.col("is_valid")).alias("rejected_rows"))
