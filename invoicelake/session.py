"""Session helpers. The library itself never creates a session; callers pass one in."""

from __future__ import annotations

import os
import sys
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(app: str = "invoicelake", cores: str = "*", shuffle_partitions: int = 8,
                  **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks. On a cluster use the session you are given."""
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once; they need it for the Arrow functions."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="invoicelake-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for file in sorted(package.rglob("*.py")):
            bundle.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one only for a local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="invoicelake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from there.

    Used where a result is read several times. The files are reliable storage, so lost executors cost nothing.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
