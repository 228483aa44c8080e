"""Price histories: an append-only table of snapshots, and what can be told from it.

A snapshot is one sight of a listing in one run.  The order of a listing's snapshots is (seen_at, seq).  Everything is
one grouped aggregate with partial sums, so a listing with very many snapshots costs no single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import truthy

KEYS = ("portal", "id")


def at() -> Column:
    return F.struct("seen_at", "seq")


def snapshots_of(listings: DataFrame, seen_at: Column, seq: str = "ordinal") -> DataFrame:
    """A run's listings as snapshots: one time for the whole run, the listing's place in the run as ``seq``."""
    return listings.withColumn("seen_at", seen_at).withColumnRenamed(seq, "seq")


def first_seen(snapshots: DataFrame) -> DataFrame:
    """portal, id, first_seen: never changes once set."""
    return snapshots.groupBy(*KEYS).agg(F.min("seen_at").alias("first_seen"))


def latest(snapshots: DataFrame, columns: Sequence[str]) -> DataFrame:
    """portal, id and the columns as the last snapshot has them, nulls included."""
    whole = snapshots.groupBy(*KEYS).agg(F.max_by(F.struct(*columns), at()).alias("latest"))
    return whole.select(*KEYS, *[F.col(f"latest.{c}").alias(c) for c in columns])


def histories(snapshots: DataFrame, columns: Sequence[str], prices: Column | None = None) -> DataFrame:
    """One row for each listing: when first seen, first and last price that isn't 0 or null, and the latest columns.

    Listings of which ``prices`` is true also have ``price_history``, as ``price_histories`` gives it; it is null for others.
    """
    priced = F.when(truthy(F.col("price_eur")), at())
    found = snapshots.groupBy(*KEYS).agg(
        F.min("seen_at").alias("first_seen"),
        F.min(at()).alias("entered"),
        F.min_by("price_eur", priced).alias("first_price"),
        F.max_by("price_eur", priced).alias("last_price"),
        F.max_by(F.struct(*columns), at()).alias("latest"),
        *([] if prices is None else [F.collect_list(F.when(prices & truthy(F.col("price_eur")), F.struct("seen_at", "seq", "price_eur"))).alias("_prices")]),
    )
    if prices is None:
        return found
    history = F.when(F.size("_prices") > 0, _in_order(F.col("_prices")))
    return found.withColumn("price_history", history).drop("_prices")


def _in_order(rows: Column) -> Column:
    return F.transform(F.array_sort(rows), lambda r: r["price_eur"])


def price_histories(snapshots: DataFrame) -> DataFrame:
    """portal, id, price_history: all prices that aren't 0 or null, in order."""
    rows = snapshots.where(truthy(F.col("price_eur"))).groupBy(*KEYS).agg(F.collect_list(F.struct("seen_at", "seq", "price_eur")).alias("rows"))
    return rows.select(*KEYS, _in_order(F.col("rows")).alias("price_history"))


def as_known_at(snapshots: DataFrame, as_of: Column) -> DataFrame:
    """The snapshots that existed at a time."""
    return snapshots.where(F.col("seen_at").cast("timestamp") <= as_of)
