"""Landed batches folded into the snapshot table by Structured Streaming.

Only the fold is a stream.  Days on the market depend on the day of asking and area means on every listing, so leads
are a batch query over the table.  A listing's history never expires, so nothing is kept in stream state: the table is
the state, and a micro-batch that is run again overwrites its own partition.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def fold(snapshots: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Starts folding a stream of snapshots into the table at ``path``.

    A run is named by the query's id, which lives in its checkpoint folder, and the batch's number: a batch that is run
    again is the same run, and another stream, or one begun anew with another folder, is never the same.
    """
    started: list[StreamingQuery] = []
    running = threading.Event()

    def write(batch: DataFrame, batch_id: int) -> None:
        running.wait()
        rows = batch.withColumn("run_id", F.lit(f"{started[0].id}-{batch_id:012d}"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)

    writer = snapshots.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    started.append((writer.trigger(availableNow=True) if available_now else writer).start())
    running.set()
    return started[0]
