"""Text, number and time functions.

Regular expressions see Unicode classes (``\\s`` holds the no-break space, ``\\w`` Cyrillic letters).  No match is null,
never the empty text.  Rounding is half to even; elapsed days are whole 24-hour periods, rounded down.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_A_DAY = 86_400_000_000


def unicode_pattern(pattern: str, ignore_case: bool = False) -> str:
    return ("(?iU)" if ignore_case else "(?U)") + pattern


def matches(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    return text.rlike(unicode_pattern(pattern, ignore_case))


def captured(text: Column, pattern: str, group: int = 1, ignore_case: bool = False) -> Column:
    """What the group of the first match holds; null without a match."""
    return F.when(matches(text, pattern, ignore_case), F.regexp_extract(text, unicode_pattern(pattern, ignore_case), group))


def stripped(text: Column) -> Column:
    """Without white space, in the Unicode sense, at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def not_empty(text: Column) -> Column:
    return F.when(text != "", text)


def first_line(lines: Column, pattern: str) -> Column:
    """The first line with a match; null if none has one."""
    return F.get(F.filter(lines, lambda line: matches(line, pattern)), F.lit(0))


def digits(text: Column) -> Column:
    """The text's digits as a number; null without any."""
    return F.regexp_replace(text, r"(?U)\D", "").try_cast("bigint")


def decimal_number(text: Column) -> Column:
    """A number with comma or point as a double; null if it isn't one."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def half_even(number: Column, places: int = 0) -> Column:
    return F.bround(number, places)


def whole(number: Column) -> Column:
    """Rounded half to even, as a bigint."""
    return F.bround(number, 0).cast("bigint")


def truthy(number: Column) -> Column:
    """True where the number is neither null nor 0."""
    return F.coalesce(number != 0, F.lit(False))


def elapsed_days(since: Column, until: Column) -> Column:
    """Whole days from ``since`` to ``until`` in integers, rounded down also below 0."""
    micros = F.unix_micros(until.cast("timestamp")) - F.unix_micros(since.cast("timestamp"))
    return F.call_function("div", micros - F.pmod(micros, F.lit(MICROS_A_DAY)), F.lit(MICROS_A_DAY))


def lines_of(text: Column) -> Column:
    """The text's lines, stripped, without empty ones."""
    return F.filter(F.transform(F.split(text, "\n"), stripped), lambda line: line != "")
