"""Dates as Bulgarian portals write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import captured

# The names of the months, and how a card tells its last change.
MONTHS = ("януари", "февруари", "март", "април", "май", "юни", "юли", "август", "септември", "октомври", "ноември", "декември")
UPDATED = r"-\s*(Днес|Вчера|Обновено на\s+(\d{1,2})\s+(\S+)\s+(\d{4})\s*г\.?)"


def updated_at(line: Column, now: Column) -> Column:
    """The timestamp a card line tells: today is ``now``, yesterday a day before, a date its midnight; else null."""
    label, day, name, year = (captured(line, UPDATED, g, ignore_case=True) for g in (1, 2, 3, 4))
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(name))
    date = F.try_make_timestamp(year.try_cast("int"), month.cast("int"), day.try_cast("int"), F.lit(0), F.lit(0), F.lit(0).cast("decimal(8,6)"))
    return (
        F.when(F.lower(label).startswith("днес"), now)
        .when(F.lower(label).startswith("вчера"), now - F.expr("INTERVAL 1 DAY"))
        .when(month > 0, date)
    )
