"""Leads: what a listing's history says about its seller, beside the average of its area."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.places import area_of_title
from ..functions.text import elapsed_days, half_even, truthy, whole
from ..session import checkpointed, stored
from .history import histories
from .ranking import ranked

# A drop of 20 % and 180 days on the market each give half of the full score.
FULL_DROP, FULL_DAYS, HALF = 20.0, 180.0, 50.0


def drop_percent(first: Column, last: Column) -> Column:
    """The fall from first to last price, in percent of the first; negative for a rise."""
    first, last = first.cast("double"), last.cast("double")
    return half_even((first - last) / first * F.lit(100.0), 1)


def motivation(drop: Column, days: Column) -> Column:
    by_drop = F.least(F.greatest(drop, F.lit(0.0)) / F.lit(FULL_DROP), F.lit(1.0)) * F.lit(HALF)
    by_days = F.least(days.cast("double") / F.lit(FULL_DAYS), F.lit(1.0)) * F.lit(HALF)
    return whole(by_drop + by_days)


def per_unit(price: Column, size: Column) -> Column:
    """Price per square metre; null where the size is 0 or null."""
    return F.when(truthy(size), whole(price.cast("double") / size.cast("double")))


def lead_rows(snapshots: DataFrame, as_of: Column, columns: Sequence[str] = ("area", "sqm"), site_date: str | None = None, prices: Column | None = None) -> DataFrame:
    """A row for each listing that ever had a price, with the metrics that need no other listing.

    With ``site_date``, a column of the listing, days count from it where it is set, and never below 0.  Listings of
    which ``prices`` is true also have all their prices in ``price_history``.
    """
    known = histories(snapshots, columns, prices).where(F.col("last_price").isNotNull())
    rows = known.select("portal", "id", "first_seen", "entered", "first_price", F.col("last_price").alias("price_eur"), *[F.col(f"latest.{c}").alias(c) for c in columns], *([] if prices is None else ["price_history"]))
    since = F.col("first_seen").cast("timestamp")
    days = elapsed_days(since, as_of)
    if site_date:
        days = F.greatest(elapsed_days(F.coalesce(F.col(site_date).cast("timestamp"), since), as_of), F.lit(0).cast("bigint"))
    rows = rows.withColumn("drop_pct", drop_percent(F.col("first_price"), F.col("price_eur"))).withColumn("days_on_market", days)
    return rows.withColumn("score", motivation(F.col("drop_pct"), F.col("days_on_market"))).withColumn("price_per_sqm", per_unit(F.col("price_eur"), F.col("sqm")))


def area_baseline(rows: DataFrame, keys: Sequence[str] = ("portal", "area")) -> DataFrame:
    """The mean price per square metre of each area, over rows that have one (not null, not 0)."""
    return rows.where(truthy(F.col("price_per_sqm"))).groupBy(*keys).agg(F.avg("price_per_sqm").alias("baseline"), F.count("*").alias("n_listings"))


def with_baseline(rows: DataFrame, keys: Sequence[str] = ("portal", "area"), means: DataFrame | None = None) -> DataFrame:
    """Adds area_avg_price_per_sqm and pct_vs_area_avg; null where a row has no price per square metre.

    The means are aggregated first, so a join brings one row for each area, not every lead of an area to one task.
    Both sides read the same exchange of snapshots by listing, so snapshots are read once; nothing runs before an action.
    ``means``, if the rows' ``area_baseline`` is at hand, is taken instead.
    """
    means = (area_baseline(rows, keys) if means is None else means).select(*[F.col(k).alias(f"_{k}") for k in keys], "baseline")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = rows.join(means, [*same, truthy(F.col("price_per_sqm"))], "left")
    percent = half_even((F.col("price_per_sqm") - F.col("baseline")) / F.col("baseline") * F.lit(100.0), 1)
    return joined.withColumn("area_avg_price_per_sqm", whole(F.col("baseline"))).withColumn("pct_vs_area_avg", percent).drop("baseline", *[f"_{k}" for k in keys])


def leads(snapshots: DataFrame, as_of: Column, columns: Sequence[str] = ("area", "sqm"), keys: Sequence[str] = ("portal", "area"), site_date: str | None = None, area: Column | None = None) -> DataFrame:
    """All metrics of all leads; ``area`` replaces the listing's area before the means are taken."""
    rows = lead_rows(snapshots, as_of, columns, site_date)
    return with_baseline(rows if area is None else rows.withColumn("area", area), keys)


def in_rank_order(rows: DataFrame) -> DataFrame:
    """Adds ``rank``: by score, highest first, and as first entered where scores are equal."""
    return ranked(rows, [F.col("score").desc(), F.col("entered").asc(), F.col("portal").asc(), F.col("id").asc()])


def portal_leads(snapshots: DataFrame, as_of: Column) -> DataFrame:
    """Leads of all portals together, each by its own rules, with all columns of their latest listings.

    Means are by portal and area.  imoti.net has no area but in its titles, and its leads alone carry their prices; a
    date that the site itself gives (olx.bg) counts instead of the first sight.  Rows are told once and checkpointed: the
    means need few of their columns, so Spark would aggregate the snapshots a second time for them.  The means are a table,
    of known size, so leads are not dealt out by area where it is small.
    """
    columns = [c for c in snapshots.columns if c not in ("portal", "id", "seen_at", "seq", "price_eur", "run_id", "page_num")]
    titled = F.when(F.col("portal") == "imoti.net", area_of_title(F.col("title"))).otherwise(F.col("area"))
    rows = lead_rows(snapshots, as_of, columns, "site_updated_at", F.col("portal") == "imoti.net").withColumn("area", titled)
    rows = checkpointed(rows)
    return with_baseline(rows, means=stored(area_baseline(rows)))
