"""Keyset paging: the rows after a key, in key order, one page at a time.

``keyset_page`` pages any frame.  ``write_clustered`` lays a table out for
paging: files of consecutive keys, and a zone map (first key, last key and rows
of every file) next to them.  ``clustered_page`` then opens only the files that
hold the page.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tanimart import config

#: Steps of the quantiles that bound a page, and the accuracy they are found
#: with: their rank is wrong by at most a tenth of a step.
STEPS = 1000
ACCURACY = 10 * STEPS
#: Rows of a clustered file.
FILE_ROWS = 200_000


def keyset_page(df: DataFrame, key: str, after=None, size: int = config.BATCH_ROWS) -> DataFrame:
    """Rows with ``key > after`` (all rows when ``after`` is None), ascending, at most ``size``.

    The key is a number and NULL keys are on no page.  One pass finds the
    number of rows and quantiles of the key; the first quantile that is surely
    behind the page bounds the second pass, so tasks hand on little more than
    one page together, not a page each.
    """
    rows = df.filter(F.col(key).isNotNull()) if after is None else df.filter(F.col(key) > F.lit(after))
    steps = ", ".join(f"{i / STEPS}D" for i in range(1, STEPS))  # as SQL: one parse instead of a call per step
    n, cuts = rows.agg(F.count(F.lit(1)), F.expr(f"percentile_approx(`{key}`, array({steps}), {ACCURACY})")).first()
    step = math.ceil(size / n * STEPS) + 1 if n else STEPS  # one more than the page: the quantile is approximate
    if step < STEPS:
        rows = rows.filter(F.col(key) <= F.lit(cuts[step - 1]))
    return rows.orderBy(key).limit(size)


def _zones_path(path: str) -> str:
    return f"{path.rstrip('/')}.zones"


def write_clustered(df: DataFrame, path: str, key: str, file_rows: int = FILE_ROWS) -> DataFrame:
    """Write ``df`` to ``path`` in files of consecutive keys, and its zone map
    next to it; returns the zone map (file, first, last, rows).

    Ranges come from Spark's sampled splitters; one key is in one range only.
    Rows without a key are written too, and are on no page."""
    n = df.count()
    laid = df.repartitionByRange(max(1, math.ceil(n / file_rows)), key).sortWithinPartitions(key)
    laid.write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    zones = (spark.read.parquet(path).filter(F.col(key).isNotNull()).groupBy(F.col("_metadata.file_path").alias("file"))
             .agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("rows")))
    zones.coalesce(1).write.mode("overwrite").parquet(_zones_path(path))
    return spark.read.parquet(_zones_path(path))


def page_files(spark: SparkSession, path: str, after=None, size: int = config.BATCH_ROWS) -> list[str]:
    """The files that hold the page: in key order, the one that ``after`` falls
    into and as many behind it as have ``size`` rows.  The zone map is one row a
    file; only those rows come to the driver."""
    zones = spark.read.parquet(_zones_path(path))
    zones = zones if after is None else zones.filter(F.col("last") > F.lit(after))
    out, rows = [], 0
    for z in zones.orderBy("first", "last").toLocalIterator():
        out.append(z.file)
        if after is None or z["first"] > after:  # the first file may hold rows before the page
            rows += z.rows
        if rows >= size:
            break
    return out


def clustered_page(spark: SparkSession, path: str, key: str, after=None, size: int = config.BATCH_ROWS) -> DataFrame:
    """``keyset_page`` of a table that ``write_clustered`` wrote: one pass over the
    page's files."""
    files = page_files(spark, path, after, size)
    rows = spark.read.parquet(*files) if files else spark.read.parquet(path).limit(0)
    rows = rows.filter(F.col(key).isNotNull() if after is None else F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(size)
