"""The snapshot table in buckets: a listing's snapshots of all runs stand in one bucket, so histories need no exchange.

Runs are appended as partitions of a table that is bucketed by listing; a run that is appended again replaces itself.
Every run adds a file to each bucket, so from time to time the runs so far are compacted into a new generation, one
sorted file a bucket.  A generation is a table of its own and the name that readers use is a view on one of them: it is
moved on when the new generation is written whole, so a reader sees the old one or the new one, and a compaction that
fails changes nothing.  Compaction and appending are the writer's work: one writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import KEYS

ORDER = (*KEYS, "seen_at", "seq")


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    usual = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def _generation(spark: SparkSession, name: str) -> int | None:
    """The number of the generation that the view shows; None before the first run."""
    if not spark.catalog.tableExists(name):
        return None
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").first()["data_type"]
    return int(re.search(r"_g(\d+)`?$", text.strip())[1])


def _write(rows: DataFrame, table: str, buckets: int, path: str | None) -> None:
    writer = rows.write.format("parquet").partitionBy("run_id").bucketBy(buckets, *KEYS).sortBy(*ORDER)
    (writer.option("path", f"{path}/{table}") if path else writer).saveAsTable(table)


def _show(spark: SparkSession, name: str, number: int) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}_g{number}")


def append_run(snapshots: DataFrame, name: str, buckets: int = 200, path: str | None = None) -> None:
    """Adds the runs of the snapshots (told by ``run_id``) to the table ``name``; runs that it has are replaced.

    ``buckets`` and ``path``, the folder of the table's files, count when the first run makes the table.
    """
    spark = snapshots.sparkSession
    number = _generation(spark, name)
    if number is None:
        _write(snapshots, f"{name}_g0", buckets, path)
        _show(spark, name, 0)
        return
    columns = spark.table(f"{name}_g{number}").columns
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        snapshots.select(*columns).write.insertInto(f"{name}_g{number}", overwrite=True)


def compact(spark: SparkSession, name: str, buckets: int = 200, path: str | None = None) -> None:
    """Writes all runs of the table as one, each bucket one sorted file, and then shows that to readers.

    The compacted run is named by the greatest of its runs, which later appends may replace only as a whole.
    """
    number = _generation(spark, name)
    if number is None:
        raise ValueError(f"{name} has no runs")
    rows = spark.table(f"{name}_g{number}")
    last = rows.agg(F.max("run_id")).first()[0]
    dealt = rows.withColumn("run_id", F.lit(f"compacted-{last}")).repartition(buckets, *KEYS)
    with _setting(spark, "spark.sql.sources.bucketing.autoBucketedScan.enabled", "false"):  # the scan deals rows by bucket, without an exchange
        _write(dealt, f"{name}_g{number + 1}", buckets, path)
    _show(spark, name, number + 1)
    if number > 0:  # readers of the generation before may still be at work; the one before that goes
        spark.sql(f"DROP TABLE IF EXISTS {name}_g{number - 1}")


def snapshots(spark: SparkSession, name: str) -> DataFrame:
    """The snapshots of all runs, scanned by bucket."""
    return spark.table(name)
