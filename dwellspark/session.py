"""Session helpers."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Arrow batches small enough that very long texts don't fill a Python worker; a session's own settings stay.
ARROW_BATCH = (("spark.sql.execution.arrow.maxRecordsPerBatch", "1000", "10000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "16m", "67108864b"))


def ship(spark: SparkSession) -> SparkSession:
    """Gives the executors this package, once a session, as ``--py-files`` would."""
    context = spark.sparkContext
    if not getattr(context, "_has_dwellspark", False):
        package = os.path.dirname(os.path.abspath(__file__))
        name = os.path.basename(package)
        folder = tempfile.mkdtemp()
        shutil.copytree(package, f"{folder}/tree/{name}", ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{folder}/{name}", "zip", f"{folder}/tree"))
        context._has_dwellspark = True
    for setting, most, default in ARROW_BATCH:
        if spark.conf.get(setting, default) == default:
            spark.conf.set(setting, most)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which the driver and all executors share.

    Where it is unset, a temporary folder serves a session that is one process; a cluster has to name its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            folder = tempfile.mkdtemp()
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage through the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written to a table in the shared folder and read again, so that later steps read the columns they need."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
