"""Session helpers.

The library never creates a session behind the caller's back; these helpers
exist for tests, the bench and the command line.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tanimart") -> SparkSession:
    """A local session with the settings the tests and bench rely on."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TANIMART_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` (or one already set on the
    context) is used as is.  A scratch folder is set only on a local master
    (tests, bench); a cluster without the setting is an error, since its
    executors share no local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tanimart-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir()


def materialize(df):
    """Compute ``df`` once into the checkpoint folder and cut its lineage.

    A task that fails fails the call.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per context, for stages
    that run Python in tasks.  Tests and programs started elsewhere than in the
    package's folder need it too."""
    sc = spark.sparkContext
    if getattr(sc, "_tanimart_shipped", False):
        return
    package = Path(__file__).resolve().parent
    if package.is_dir():  # not when the package itself came as a zip file
        target = Path(tempfile.mkdtemp(prefix="tanimart-code-")) / f"{package.name}.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(target))
    sc._tanimart_shipped = True
