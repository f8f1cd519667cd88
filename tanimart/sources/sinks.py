"""Table sinks on the cluster file system.

``replace`` never leaves readers with a half-written table: each write goes
to a fresh version folder and a small pointer file is swapped afterwards
(write-then-rename).  A failed or refused build leaves the previous
version in place.  ``append`` adds files; ``overwrite_partitions`` replaces
only the partitions present in the new data.  ``expire`` removes versions
that a later one replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

POINTER = "_CURRENT"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, jvm = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(path + f".tmp-{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    # FileContext renames over an existing file in one step, so a reader finds
    # the old pointer or the new one
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(tmp), fs.makeQualified(p), options)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    line = reader.readLine()
    reader.close()
    return line


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def current_path(spark: SparkSession, table_path: str) -> str | None:
    """Folder of the published version of a replaced table (None if never built)."""
    version = _read_text(spark, f"{table_path}/{POINTER}")
    return f"{table_path}/{version}" if version else None


def read_current(spark: SparkSession, table_path: str) -> DataFrame:
    path = current_path(spark, table_path)
    if path is None:
        raise FileNotFoundError(f"no published version under {table_path}")
    return spark.read.parquet(path)


def expire(spark: SparkSession, table_path: str, keep: int = 2, spare: tuple[str, ...] = ()) -> list[str]:
    """Remove old versions of a replaced table; returns the folders removed.

    The published version stays, and of the complete ones written before it the
    ``keep`` - 1 newest, for readers that opened them, and those whose folder is
    in ``spare``.  Age is that of the job's success marker, so unfinished and
    not yet published versions are never touched.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    current = current_path(spark, table_path)
    if current is None:
        return []
    fs, p, jvm = _fs(spark, table_path)

    def written(folder: str) -> int | None:
        marker = jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
        return fs.getFileStatus(marker).getModificationTime() if fs.exists(marker) else None

    published = written(current)
    if published is None:
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    ages = {f"{table_path}/{n}": written(f"{table_path}/{n}") for n in names if n.startswith("v-")}
    older = sorted((f for f, age in ages.items() if f != current and age is not None and age < published), key=lambda f: (ages[f], f), reverse=True)
    gone = [f for f in older[keep - 1:] if f not in spare]
    for folder in gone:
        fs.delete(jvm.org.apache.hadoop.fs.Path(folder), True)
    return gone


class EmptyResult(RuntimeError):
    """A build produced no rows where rows are required; nothing was published."""


def replace(df: DataFrame, table_path: str, partition_by: list[str] | None = None,
            max_records_per_file: int | None = None, require_rows: bool = False,
            sort_within: list[str] | None = None) -> int:
    """Write ``df`` as a new version and publish it; returns the row count.

    The count is observed during the write (no second pass).  With
    ``require_rows`` an empty result is not published and raises.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    obs = Observation(f"rows_{version.replace('-', '_')}")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    writer = out.write.mode("overwrite")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{table_path}/{version}")
    rows = int(obs.get.get("rows", 0))
    if require_rows and rows == 0:
        raise EmptyResult(f"{table_path}: build produced no rows; previous version kept")
    _write_text(spark, f"{table_path}/{POINTER}", version)
    return rows


def append(df: DataFrame, path: str) -> int:
    """Append rows (new files) to a table folder; returns rows written."""
    obs = Observation(f"append_{uuid.uuid4().hex}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return int(obs.get.get("rows", 0))


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
