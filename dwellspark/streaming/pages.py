"""Which pages of a run count, told while they arrive, in whatever order.

A run ends before its first page that stops it.  The smallest such page is the run's state, beside the pages that count
so far; when an earlier stop arrives, pages from there on are withdrawn.  What is told of a page is +1 when it begins to
count and -1 when it is withdrawn; the changes so far add up to the pages that count.  A run's state is bounded by its
portal's number of pages; a page that arrives twice is told once; pages without a number don't count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.dedup import RUN
from .state import started, travels


class Prefix(StatefulProcessor):
    """Keeps the smallest stopping page and the pages that count; gives the changes."""

    def __init__(self, names: Sequence[str]):
        self.names = list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stop = handle.getValueState("stop", "page bigint")
        self.counting = handle.getMapState("counting", "page bigint", "seen boolean")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = self.stop.get()[0] if self.stop.exists() else None
        found = [(r["page"], r["stops"]) for r in rows if r["page"] is not None]
        stop = min([page for page, stops in found if stops] + ([] if before is None else [before]), default=None)
        told = []
        if stop is not None and stop != before:
            self.stop.update((stop,))
            for (page,) in [tuple(k) for k in self.counting.keys()]:  # noqa: SIM118
                if page >= stop:
                    self.counting.removeKey((page,))
                    told.append((page, -1))
        for page in sorted({page for page, _ in found if stop is None or page < stop}):
            if not self.counting.containsKey((page,)):
                self.counting.updateValue((page,), (True,))
                told.append((page, 1))
        for page, change in told:
            yield Row(**dict(zip(self.names, (*key, page, change), strict=True)))

    def close(self) -> None:
        pass


def counting_changes(pages: DataFrame, stop: Column, keys: Sequence[str] = RUN, page: str = "page_num") -> DataFrame:
    """A stream of pages as a stream of keys, page and change (+1 or -1)."""
    types = dict(pages.dtypes)
    names = [*keys, page, "change"]
    rows = pages.select(*keys, F.col(page).cast("bigint").alias("page"), F.coalesce(stop, F.lit(False)).alias("stops"))
    out = ", ".join([*(f"{k} {types[k]}" for k in keys), f"{page} bigint", "change int"])
    travels(__name__)
    return rows.groupBy(*keys).transformWithState(Prefix(names), out, "Update", "None")


def follow_pages(pages: DataFrame, stop: Column, path: str, checkpoint: str, keys: Sequence[str] = RUN, page: str = "page_num", available_now: bool = True, then: Callable[[int], None] | None = None) -> StreamingQuery:
    """Starts a query that writes the changes to ``path``."""
    return started(counting_changes(pages, stop, keys, page), checkpoint, lambda batch, put: put(batch, path), available_now, then)


def counting_pages(spark: SparkSession, path: str, keys: Sequence[str] = RUN, page: str = "page_num") -> DataFrame:
    """keys and page of the pages that count as of the last batch."""
    return spark.read.parquet(path).groupBy(*keys, page).agg(F.sum("change").alias("change")).where("change > 0").drop("change")
