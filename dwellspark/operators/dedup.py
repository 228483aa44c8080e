"""One listing for each id of a run, and the pages that count.

Both rules are aggregates with partial sums, not windows, so an id that occurs very often is no single task's work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = ("portal", "run_id")


def _one(rows: DataFrame, chosen: Column, keys: Sequence[str]) -> DataFrame:
    """The row that ``chosen`` takes of each id, and ``first_at``: where the id first stood."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(chosen.alias("_row"), F.min(F.struct("page_num", "pos")).alias("first_at"))
    return best.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest], "first_at")


def first_wins(rows: DataFrame, keys: Sequence[str] = (*RUN, "id")) -> DataFrame:
    """Valid rows only in, the first of each id out."""
    whole = F.struct(*[c for c in rows.columns if c not in keys])
    return _one(rows, F.min_by(whole, F.struct("page_num", "pos")), keys)


def last_page_wins(rows: DataFrame, keys: Sequence[str] = (*RUN, "id")) -> DataFrame:
    """The first of each id on the last page that has it; its place is still that of its first page."""
    whole = F.struct(*[c for c in rows.columns if c not in keys])
    return _one(rows, F.max_by(whole, F.struct(F.col("page_num"), -F.col("pos"))), keys)


def by_rule(rows: DataFrame, late: Column, keys: Sequence[str] = (*RUN, "id")) -> DataFrame:
    """``last_page_wins`` for the ids whose rows are ``late``, ``first_wins`` for the others, in one aggregate."""
    whole = F.struct(*[c for c in rows.columns if c not in keys])
    page = F.when(late, -F.col("page_num")).otherwise(F.col("page_num"))
    return _one(rows, F.min_by(whole, F.struct(page, "pos")), keys)


def until_stop(pages: DataFrame, stop: Column, keys: Sequence[str] = RUN, page: str = "page_num") -> DataFrame:
    """The pages of each run before the first that stops it."""
    ends = pages.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(F.when(stop, F.col(page))).alias("_end"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return pages.join(ends, same).where(F.col("_end").isNull() | (F.col(page) < F.col("_end"))).select(*pages.columns)
