"""Name matching against a dictionary, with manual overrides, and its audit."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tanimart import config
from tanimart.functions import text as tx

OVERRIDE_SCHEMA = pa.schema([("override_from", pa.string()), ("override_to", pa.string())])


def overrides_frame(spark: SparkSession, overrides: dict[str, str] | None = None) -> DataFrame:
    """The override map as a constant relation; empty map -> no rows.

    From an Arrow table, so it is a literal in the plan: Spark knows its size
    and broadcasts it without a shuffle of the other side."""
    overrides = config.NAME_OVERRIDES if overrides is None else overrides
    columns = [list(overrides.keys()), list(overrides.values())]
    return spark.createDataFrame(pa.table(columns, schema=OVERRIDE_SCHEMA))


#: Keys that the sketch tracks, and how many of them are looked at.
TRACKED, LOOKED_AT = 10_000, 200


def hot_keys(keys: DataFrame, key: str, tasks: int) -> dict[str, int]:
    """{key: shares} of keys that hold more rows than half of a task's share.

    One pass with a frequent-items sketch of fixed size; its counts may be too
    low by 1/TRACKED of the rows, far below a task's share."""
    n, top = keys.agg(F.count(F.lit(1)), F.expr(f"approx_top_k({key}, {LOOKED_AT}, {TRACKED})")).first()
    least = n / (2 * tasks)
    return {r[0]: min(tasks, math.ceil(r[1] / least)) for r in top or [] if r[0] is not None and r[1] > least} if n else {}


def _split_hot(keyed: DataFrame, entries: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_share``: rows of a hot key are dealt to its shares, the
    key's entries are copied to each of them; all others have share 0."""
    spark = keyed.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = hot_keys(keyed.select(key), key, tasks)
    if not hot:
        return keyed.withColumn("_share", F.lit(0)), entries.withColumn("_share", F.lit(0))
    table = spark.createDataFrame(pa.table({"_hot": list(hot), "_shares": pa.array(hot.values(), pa.int32())}))  # at most LOOKED_AT rows
    shares = F.coalesce("_shares", F.lit(1))
    dealt = lambda df: df.join(F.broadcast(table), df[key] == table["_hot"], "left").drop("_hot")
    left = dealt(keyed).withColumn("_share", F.pmod(F.monotonically_increasing_id(), shares).cast("int")).drop("_shares")
    right = dealt(entries).withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("_shares")
    return left, right


def match_names(typed: DataFrame, dictionary: DataFrame, overrides: DataFrame,
                name_col: str = "compound_name", dict_name: str = "name",
                dict_id: str = "matched_id") -> DataFrame:
    """typed LEFT JOIN overrides LEFT JOIN dictionary on normalised names.

    The lookup key is the override target when the (trimmed, lower-cased)
    name has one, else the name itself.  A name that appears several times
    in the dictionary yields one row per entry (fan-out, kept on purpose:
    the rows are real alternatives).  The overrides are a literal and are
    broadcast; names that many rows share are dealt to several tasks of the
    second join.
    """
    ov = overrides.select(tx.normalized_name("override_from").alias("_ov_key"),
                          F.col("override_to").alias("_ov_to"))
    keyed = (typed.withColumn("_ov_key", tx.normalized_name(name_col))
             .join(ov, "_ov_key", "left")
             .withColumn("_name_key", F.lower(F.coalesce(F.col("_ov_to"), F.trim(F.col(name_col)))))
             .drop("_ov_key", "_ov_to"))
    d = dictionary.select(F.lower(F.col(dict_name)).alias("_name_key"), F.col(dict_id))
    keyed, d = _split_hot(keyed, d, "_name_key")
    return keyed.join(d, ["_name_key", "_share"], "left").drop("_name_key", "_share")


def match_audit(raw: DataFrame, dictionary: DataFrame, overrides: DataFrame,
                name_col: str = "compound_name", dict_name: str = "name") -> DataFrame:
    """One row of load counts, from one pass over the input.

    total input rows; kept (has a name); dropped (no name); output rows;
    unmatched output rows; fan-out = extra rows from duplicate names.  The
    dictionary is reduced to entries per name first, so every input row stays
    one row and carries its own counts.
    """
    entries = dictionary.groupBy(F.lower(F.col(dict_name)).alias("_name")).agg(F.count(F.lit(1)).alias("_entries"))
    named = match_names(raw.select(F.col(name_col)), entries, overrides, name_col, "_name", "_entries")
    kept = F.coalesce(tx.is_present(name_col), F.lit(False))
    out = F.when(kept, F.coalesce("_entries", F.lit(1))).otherwise(0)
    return named.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(kept).alias("kept_rows"),
        F.count_if(~kept).alias("dropped_rows"), F.coalesce(F.sum(out), F.lit(0)).alias("output_rows"),
        F.count_if(kept & F.col("_entries").isNull()).alias("unmatched_rows"),
    ).withColumn("fanout_rows", F.col("output_rows") - F.col("kept_rows"))
