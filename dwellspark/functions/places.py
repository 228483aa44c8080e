"""Names of areas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import not_empty, stripped

DEFAULT_AREA = "Sofia"


def without_repeated_head(area: Column) -> Column:
    """If the first word occurs again, the words from its last occurrence on; else the area as it is."""
    words = F.filter(F.split(area, r"(?U)\s+"), lambda w: w != "")
    from_end = F.array_position(F.reverse(words), F.get(words, F.lit(0)))
    again = (F.size(words) > 1) & (from_end < F.size(words))
    return F.when(again, F.array_join(F.slice(words, F.size(words) - from_end + 1, from_end), " ")).otherwise(area)


def area_of_title(title: Column) -> Column:
    """What stands between the first and second ``Sofia,`` of a title; the default area if there is none."""
    parts = F.split(title, r"(?iU)Sofia,\s*")
    return F.when(F.size(parts) > 1, stripped(F.get(parts, F.lit(1)))).otherwise(DEFAULT_AREA)


def area_of_location(location: Column) -> Column:
    """What stands before ``, София``; the default area if that is empty."""
    return F.coalesce(not_empty(stripped(F.get(F.split(location, r"(?U),\s*София"), F.lit(0)))), F.lit(DEFAULT_AREA))
