"""The load log: one row per (table, version) load, newest wins.

Parquet tables have no MERGE, so the log is append-only and "upsert" is a
read-side rule: per (table, version) the row with the latest ``loaded_at``;
per table the current version is the one loaded last.  Both are plain
aggregates (max of a struct ordered by time), so a table with a huge log
is combined map-side and never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("version", T.StringType(), False),
    T.StructField("loaded_at", T.TimestampType(), False),
    T.StructField("row_count", T.LongType(), True),
])


def log_rows(spark: SparkSession, rows: list[tuple[str, str, int]]) -> DataFrame:
    """New log rows (table, version, row count) stamped with the current time."""
    return spark.createDataFrame(rows, "table_name string, version string, row_count bigint").select(
        "table_name", "version", F.current_timestamp().alias("loaded_at"), "row_count")


def current_entries(log: DataFrame) -> DataFrame:
    """Per (table, version): the latest row (upsert semantics)."""
    latest = log.groupBy("table_name", "version").agg(
        F.max(F.struct("loaded_at", "row_count")).alias("_m"))
    return latest.select("table_name", "version", "_m.loaded_at", "_m.row_count")


def latest_version(log: DataFrame) -> DataFrame:
    """Per table: the version loaded last (ties: larger version, then count)."""
    latest = log.groupBy("table_name").agg(
        F.max(F.struct("loaded_at", "version", "row_count")).alias("_m"))
    return latest.select("table_name", "_m.version", "_m.loaded_at", "_m.row_count")


def events_as_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table read as a load log (event type = table, user = version)."""
    from tanimart.sources import tables
    e = tables.read_table(spark, sf_dir, "events", ["event_type", "user_id", "ts", "event_id"])
    return e.select(F.col("event_type").alias("table_name"),
                    F.col("user_id").cast("string").alias("version"),
                    F.col("ts").alias("loaded_at"),
                    F.col("event_id").alias("row_count"))
