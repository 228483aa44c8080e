"""Histories as keyed state of a stream: each listing's summary and snapshots live in the state store under its key.

A micro-batch reads and writes the state of the listings it brings and no others, whatever the table's size, and tells
for each of them what it was before and is now.  From that, area means are kept up by changes: a listing's old
contribution is taken off its old area, its new one added to its new area.  State and progress are in the query's
checkpoint folder, so a query that is killed goes on where its last batch was committed; what a batch wrote before it
was killed is written over.

The order in which snapshots arrive doesn't matter: a listing's first and last are by (seen_at, seq), as in
``operators.history``.  A snapshot without a time or a number is ordered before all others.
"""

from __future__ import annotations

import sys
import threading
from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.text import truthy
from ..operators.history import KEYS
from ..operators.leads import per_unit

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Times are microseconds in the state, which no time zone can shift.  What a batch brings of a listing is one entry of at
#: most CHUNK snapshots: an entry crosses to the store by itself, which costs far more than what it holds.
SNAPSHOT = "seen_at array<bigint>, seq array<bigint>, price_eur array<bigint>"
CHUNK = 10_000


#: What is known of a listing, beside its latest columns: times and numbers of its first and last price and its latest sight.
KNOWN = ("n", "first_seen", "first_time", "first_seq", "first_price", "last_time", "last_seq", "last_price", "latest_time", "latest_seq")


def travels(module: str) -> None:
    """Lets a module's processors travel with their code: the worker that prepares a stream's state has no shipped packages."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def _order(time: int | None, seq: int | None) -> tuple:
    return (time is not None, time or 0, seq is not None, seq or 0)


class Histories(StatefulProcessor):
    """Keeps ``known``, a listing's summary, and ``snapshots``, all its times and prices; gives both states of what changed."""

    def __init__(self, types: dict[str, str], names: Sequence[str]):
        self.types, self.names = types, list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = ", ".join([*(f"{k} bigint" for k in KNOWN), *(f"_{c} {t}" for c, t in self.types.items())])
        self.known = handle.getValueState("known", schema)
        self.snapshots = handle.getListState("snapshots", SNAPSHOT)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        found, n = list(rows), len(KNOWN)
        old = self.known.get() if self.known.exists() else (0, *[None] * (n - 1 + len(self.types)))
        know, latest = dict(zip(KNOWN, old[:n], strict=True)), tuple(old[n:])
        before = (know["n"] > 0, know["last_price"], *latest)
        at_row = len(KEYS)
        told = [row[at_row : at_row + 3] for row in found]
        for row, (time, seq, price) in zip(found, told, strict=True):
            at = _order(time, seq)
            if time is not None and (know["first_seen"] is None or time < know["first_seen"]):
                know["first_seen"] = time
            if price:
                if know["first_price"] is None or at < _order(know["first_time"], know["first_seq"]):
                    know |= {"first_time": time, "first_seq": seq, "first_price": price}
                if know["last_price"] is None or at >= _order(know["last_time"], know["last_seq"]):
                    know |= {"last_time": time, "last_seq": seq, "last_price": price}
            if not know["n"] or at >= _order(know["latest_time"], know["latest_seq"]):
                know |= {"latest_time": time, "latest_seq": seq}
                latest = tuple(row[at_row + 3 :])
            know["n"] += 1
        self.known.update((*know.values(), *latest))
        for start in range(0, len(told), CHUNK):
            self.snapshots.appendValue(tuple(map(list, zip(*told[start : start + CHUNK], strict=True))))
        now = (*key, *(know[k] for k in ("n", "first_seen", "first_price", "last_price")), *latest)
        yield Row(**dict(zip(self.names, (*now, *before), strict=True)))

    def close(self) -> None:
        pass


def changed_listings(snapshots: DataFrame, columns: Sequence[str] = ("area", "sqm")) -> DataFrame:
    """A stream of snapshots as a stream of listings that changed: their summaries, and ``was_`` columns of before.

    ``n`` counts the listing's snapshots, so of a listing's rows the one with the greatest ``n`` holds.
    """
    types = dict(snapshots.dtypes)
    times = [c for c in columns if types[c].startswith("timestamp")]
    kept = {c: "bigint" if c in times else types[c] for c in columns}
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp")).alias(c)
    now = {k: types[k] for k in KEYS} | dict.fromkeys(("n", "first_seen", "first_price", "last_price"), "bigint") | kept
    out = now | {"known": "boolean", "was_price": "bigint"} | {f"was_{c}": t for c, t in kept.items()}
    rows = snapshots.select(*KEYS, micros("seen_at"), "seq", "price_eur", *[micros(c) if c in times else c for c in columns])
    travels(__name__)
    found = rows.groupBy(*KEYS).transformWithState(Histories(kept, list(out)), ", ".join(f"{c} {t}" for c, t in out.items()), "Update", "None")
    return found.withColumns({c: F.timestamp_micros(c) for c in ("first_seen", *times, *(f"was_{t}" for t in times))})


def area_changes(changed: DataFrame, keys: Sequence[str] = ("portal", "area")) -> DataFrame:
    """keys, total, listings: what a batch of changed listings adds to the sums and counts of their areas, or takes off."""
    now, was = per_unit(F.col("last_price"), F.col("sqm")), per_unit(F.col("was_price"), F.col("was_sqm"))
    own = [F.col(k) for k in keys]
    old = [F.col(f"was_{k}" if k not in KEYS else k).alias(k) for k in keys]
    added = changed.select(*own, now.alias("per_sqm"), F.lit(1).alias("sign"))
    taken = changed.where("known").select(*old, was.alias("per_sqm"), F.lit(-1).alias("sign"))
    rows = added.unionByName(taken).where(truthy(F.col("per_sqm")))
    sums = rows.groupBy(*keys).agg(F.sum(F.col("per_sqm") * F.col("sign")).alias("total"), F.sum("sign").cast("bigint").alias("listings"))
    return sums.where("total <> 0 or listings <> 0")


def baseline_of(changes: DataFrame, keys: Sequence[str] = ("portal", "area")) -> DataFrame:
    """Area means from the changes so far: keys, baseline, n_listings, as ``operators.leads.area_baseline`` has them."""
    sums = changes.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("listings").alias("n_listings"))
    return sums.where("n_listings > 0").select(*keys, (F.col("total").cast("double") / F.col("n_listings")).alias("baseline"), "n_listings")


def started(changed: DataFrame, checkpoint: str, write: Callable[[DataFrame, Callable], None], available_now: bool = True, then: Callable[[int], None] | None = None) -> StreamingQuery:
    """Starts a query over keyed state.  ``write`` gets each batch and ``put(rows, path)``, which writes a partition of the batch's own
    and gives it read back, so that no batch is computed twice.

    Partitions are named by the query's id and the batch's number, so a batch that is run again writes over what it
    wrote.  ``then`` is called after a batch is written and before it is committed.
    """
    spark = changed.sparkSession
    query: list[StreamingQuery] = []
    running = threading.Event()

    def each(batch: DataFrame, batch_id: int) -> None:
        running.wait()
        name = f"{query[0].id}-{batch_id:012d}"

        def put(rows: DataFrame, to: str) -> DataFrame:
            named = rows.withColumn("batch", F.lit(name))
            named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(to)
            return batch.sparkSession.read.schema(named.schema).parquet(to).where(F.col("batch") == name).drop("batch")

        write(batch, put)
        if then:
            then(batch_id)

    usual = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)  # the query takes the session's settings as they are when it starts
    try:
        writer = changed.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
        query.append((writer.trigger(availableNow=True) if available_now else writer).start())
    finally:
        spark.conf.set(PROVIDER, usual) if usual else spark.conf.unset(PROVIDER)
    running.set()
    return query[0]


def follow(snapshots: DataFrame, path: str, checkpoint: str, columns: Sequence[str] = ("area", "sqm"), keys: Sequence[str] = ("portal", "area"), available_now: bool = True, then: Callable[[int], None] | None = None) -> StreamingQuery:
    """Starts a query that keeps histories in state; ``path`` gets ``listings``, the changed ones, and ``areas``, the changes of sums."""

    def write(batch: DataFrame, put: Callable) -> None:
        put(area_changes(put(batch, f"{path}/listings"), keys), f"{path}/areas")

    return started(changed_listings(snapshots, columns), checkpoint, write, available_now, then)


def current_listings(spark: SparkSession, path: str) -> DataFrame:
    """The summaries as of the last batch, one row for each listing."""
    rows = spark.read.parquet(f"{path}/listings")
    rest = [c for c in rows.columns if c not in KEYS and c not in ("known", "batch") and not c.startswith("was_")]
    best = rows.groupBy(*KEYS).agg(F.max_by(F.struct(*rest), "n").alias("_row"))
    return best.select(*KEYS, "_row.*")


def snapshots_in_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """portal, id, seen_at, seq, price_eur: all snapshots that the state store holds as of the last committed batch."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "snapshots").load()
    names = ("seen_at", "seq", "price_eur")
    each = state.select("key.*", F.inline(F.arrays_zip(*[F.col(f"list_element.{c}") for c in names])).alias(*names))
    return each.withColumn("seen_at", F.timestamp_micros("seen_at"))
