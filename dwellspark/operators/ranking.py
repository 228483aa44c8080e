"""A global order without one task that sees every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed


def ranked(rows: DataFrame, order: Sequence[Column], to: str = "rank") -> DataFrame:
    """Adds ranks from 1: rows are dealt out by ranges of the order, and each range starts where the one before ended."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = checkpointed(dealt.withColumns({"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    starts, before = [], 0
    for r in sorted(placed.groupBy("_range").agg(F.count("*").alias("n")).collect()):  # a row for each range
        starts.append((r["_range"], before))
        before += r["n"]
    starts = rows.sparkSession.createDataFrame(starts, "_of int, _start bigint")
    return placed.join(F.broadcast(starts), F.col("_range") == F.col("_of")).select(*rows.columns, (F.col("_start") + F.col("_place") + 1).alias(to))


def top(rows: DataFrame, order: Sequence[Column], k: int, to: str = "rank") -> DataFrame:
    """The first k rows of the order, with ranks; each task keeps k rows at most."""
    return rows.orderBy(*order).limit(k).withColumn(to, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
