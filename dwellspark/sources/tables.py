"""Readers and writers.

Fetching pages is no part of the engine: a crawl lands them (see ``schema.PAGE``), and everything can be run again.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.leads import in_rank_order
from ..schema import PAGE
from .histories import history_files  # noqa: F401


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages as a table, by portal, so that a portal's pages are read alone."""
    return spark.read.schema(PAGE).parquet(path)


def append_run(snapshots: DataFrame, path: str) -> None:
    """Adds a run's snapshots (with ``run_id``) to the table; running it again replaces the run, so nothing doubles."""
    snapshots.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def write_leads(leads: DataFrame, path: str, form: str = "json") -> None:
    """Ranked leads; ``rank`` is a column, since files keep no order among them."""
    in_rank_order(leads).write.mode("overwrite").format(form).save(path)


def publish_leads(leads: DataFrame, path: str, form: str = "parquet") -> None:
    """Writes ranked leads as a new version beside the published one, and then makes that the published one.

    A version is a folder of its own.  What is published is told by ``manifest``, to which each version adds one row when
    all of it is written; a row is one file, which appears at once.  A write that fails leaves a folder nobody reads.
    """
    spark, version = leads.sparkSession, uuid.uuid4().hex
    in_rank_order(leads).write.format(form).save(f"{path}/versions/{version}")
    told = _versions(spark, path)
    number = 1 + max((r["number"] for r in told), default=0)
    row = spark.createDataFrame([(number, version, form)], MANIFEST).coalesce(1)
    row.write.mode("append").parquet(f"{path}/manifest")


MANIFEST = "number bigint, version string, form string"


def _versions(spark: SparkSession, path: str) -> list:
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest").collect()  # a row for each version
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def published_leads(spark: SparkSession, path: str) -> DataFrame:
    """The leads that were last published whole."""
    told = _versions(spark, path)
    if not told:
        raise ValueError(f"nothing is published in {path}")
    last = max(told, key=lambda r: (r["number"], r["version"]))
    return spark.read.format(last["form"]).load(f"{path}/versions/{last['version']}")


def counted(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows, and their number once an action has gone through them; no pass of its own."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen
