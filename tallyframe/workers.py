"""Python code for executors that don't have this package installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all machines share. Only where it is unset and Spark runs
    on this machine alone (tests, notebooks) a temporary one serves; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if getattr(context, "_tallyframe_folder", None) is None:
        context._tallyframe_folder = tempfile.mkdtemp(prefix="spark-")
    return context._tallyframe_folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in the context's checkpoint folder, or that of ``spark.checkpoint.dir``."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of files wherever Spark can write."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once for a context, through Spark's own file server."""
    context = spark.sparkContext
    if getattr(context, "_tallyframe_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if not root.is_dir():  # already running from an archive
        return
    target = Path(tempfile.mkdtemp(prefix="spark-")) / "tallyframe_modules.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, Path(root.name) / path.relative_to(root))
    context.addPyFile(str(target))
    context._tallyframe_shipped = True
