"""Shared helpers of the training-data operators.

Tables are written to and reread from the folder that the cluster names in
``spark.checkpoint.dir``; a scratch folder is used only on a local master
where that setting is absent (tests).
"""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a table of ids is broadcast (counted first; 8 to 24 bytes
#: each).  Above it the same join runs as a shuffle join.
BROADCAST_ROWS = 500_000


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per session's context."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="llm-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._llm_shipped = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-shared-")
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir()
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage
    ends there, and the rows are computed once."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table of few narrow columns) marked for broadcast if
    its counted rows are within the bound, else as it is."""
    return F.broadcast(df) if df.count() <= rows else df


def as_long(col):
    """A 60-bit integer from the first 15 hex digits of an MD5 column."""
    return F.conv(F.substring(col, 1, 15), 16, 10).cast("long")


def settle(spark: SparkSession) -> None:
    """Drop what finished steps left: once their plans are garbage, Spark's
    cleaner deletes their shuffle files on all executors."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
