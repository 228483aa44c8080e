"""Quality rules: a table of thresholds compiled into one projection of counts and ratios, without user functions.

A rule compares the ratio of two counts with a limit in thousandths, in integers: ``1000 * over`` against ``limit *
under``.  A document is kept if no rule of the table fails.  Everything about a document is told from its own row: no
exchange, no Python, no state; very long texts cost n log n for the sort of their three-word windows.

Defined cases: a null text is an empty one and has no word; a ratio whose lower count is 0 never fails its rule (such
texts fail by their number of words); repeated rows and null ids are judged each for itself; further columns, whatever
their names, are no obstacle; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

WORD = r"[^\x20\x09-\x0D]"
SPACES = " \t\n\x0b\f\r"
#: Symbols, as they stand in a pattern's class.
SYMBOLS = "#*$%&|<>"
#: Signs at a word's ends that don't count when it is looked up among the stop words.
PUNCTUATION = ".,;:!?\"'()[]"
#: Frequent function words of the corpus' languages; a corpus in others brings its own.
STOP_WORDS = (
    "the of and to in is that for with as on are this be by at from was it an",
    "de la le et les des en un une du dans que pour par sur est qui au",
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine",
    "el los las del se por con para una al lo como más su",
)


@dataclass(frozen=True)
class Rule:
    """``over`` / ``under`` may be at most (or, with ``least``, has to be at least) ``limit`` thousandths."""

    name: str
    over: str
    limit: int
    under: str = "one"
    least: bool = False

    def fails(self, count: dict[str, Column]) -> Column:
        over, bound = count[self.over] * 1000, count[self.under] * self.limit
        return over < bound if self.least else over > bound


#: What every table begins with: too few words, too many words in repeated windows.
BASE = (Rule("words", "n_words", 50_000, least=True), Rule("repeated_windows", "n_repeat_words", 500, "n_words"))
RULES = (
    Rule("mean_length_low", "word_chars", 3000, "n_words", least=True),
    Rule("mean_length_high", "word_chars", 10_000, "n_words"),
    Rule("symbols", "n_symbols", 100, "n_words"),
    Rule("lettered", "n_lettered", 800, "n_words", least=True),
    Rule("capitals", "n_capitals", 400, "n_letters"),
    Rule("stop_words", "n_stop_words", 20, "n_words", least=True),
    Rule("duplicate_lines", "n_dup_lines", 500, "n_lines"),
    Rule("bullets", "n_bullets", 900, "n_lines"),
    Rule("ellipses", "n_ellipses", 300, "n_lines"),
)


def _kept_chars(text: Column, pattern: str) -> Column:
    """The number of code points outside the pattern's runs."""
    return F.length(F.regexp_replace(text, pattern, ""))


def _windows(words: Column) -> Column:
    """Every three consecutive words, joined by spaces."""
    n = F.size(words)
    two = F.zip_with(words, F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))
    three = F.zip_with(two, F.slice(words, F.lit(3), n), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.slice(three, F.lit(1), F.greatest(n - 2, F.lit(0)))


def _sorted(windows: Column) -> Column:
    """The windows with their places, sorted, so that equal ones are neighbours; none where all differ."""
    placed = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), placed).otherwise(F.array().cast("array<struct<w: string, i: int>>"))


def _repeated(windows: Column) -> Column:
    """The sorted places of the windows that occur twice or more."""
    same = F.zip_with(windows, F.slice(windows, F.lit(2), F.size(windows)), lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))


def _covered(places: Column) -> Column:
    """The number of words in three-word windows at the sorted places."""
    each = F.zip_with(places, F.slice(places, F.lit(2), F.size(places)), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    return F.aggregate(each, F.lit(0).cast("long"), lambda total, n: total + n)


def counts(docs: DataFrame, stop_words: Sequence[str] = STOP_WORDS, text_col: str = "text") -> tuple[DataFrame, dict[str, Column]]:
    """The rows with hidden columns, and the counts as expressions over them."""
    hidden = {name: fresh(docs, f"_{name}") for name in ("text", "words", "lines", "windows", "sorted", "places")}
    text, words, lines = (F.col(hidden[k]) for k in ("text", "words", "lines"))
    rows = docs.withColumn(hidden["text"], F.coalesce(F.col(text_col), F.lit("")))
    rows = rows.withColumns({
        hidden["words"]: F.regexp_extract_all(text, F.lit(WORD + "+"), F.lit(0)),
        hidden["lines"]: F.filter(F.transform(F.split(text, "\n"), lambda x: F.when(F.btrim(x, F.lit(SPACES)) != "", x)), lambda x: x.isNotNull()),
    })
    rows = rows.withColumn(hidden["windows"], _windows(words))
    rows = rows.withColumn(hidden["sorted"], _sorted(F.col(hidden["windows"])))
    rows = rows.withColumn(hidden["places"], _repeated(F.col(hidden["sorted"])))
    stops = sorted({w for group in stop_words for w in group.split()})
    starts = lambda *marks: lambda x: F.btrim(x, F.lit(SPACES)).rlike("^[" + "".join(marks) + "]")
    many = lambda array, test: F.size(F.filter(array, test))
    found = {
        "one": F.lit(1),
        "n_words": F.size(words),
        "word_chars": _kept_chars(text, r"[\x20\x09-\x0D]+"),
        "n_symbols": _kept_chars(text, "[^" + SYMBOLS + "]+"),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _covered(F.col(hidden["places"])),
        "n_lettered": F.regexp_count(text, F.lit(rf"(?<!{WORD})[^\x20\x09-\x0D\p{{L}}]*+\p{{L}}")),
        "n_letters": _kept_chars(text, r"\P{L}+"),
        "n_capitals": _kept_chars(text, r"\P{Lu}+"),
        "n_stop_words": many(words, lambda w: F.lower(F.btrim(w, F.lit(PUNCTUATION))).isin(*stops)),
        "n_bullets": many(lines, starts("*", "•", r"\-")),
        "n_ellipses": many(lines, lambda x: F.rtrim(x, F.lit(SPACES)).rlike(r"(\.\.\.|…)$")),
    }
    return rows, {name: count.cast("long") for name, count in found.items()}


def judge(docs: DataFrame, keep: Sequence[str], rules: Sequence[Rule] = RULES, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """The columns ``keep``, the base counts, base_failed, kept, and ``failed``: the names of all rules that fail, comma-joined."""
    rows, count = counts(docs, stop_words)
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    own = {name: fresh(rows, f"_{name}") for name in count}
    rows = rows.select(*[F.col("`" + c.replace("`", "``") + "`") for c in keep], *[count[name].alias(own[name]) for name in count])
    known = {name: F.col(own[name]) for name in count}
    any_of = lambda table: F.array_join(F.array_compact(F.array(*[F.when(r.fails(known), r.name) for r in table])), ",")
    return rows.select(
        *[F.col("`" + c.replace("`", "``") + "`") for c in keep], *[known[name].alias(name) for name in base],
        (any_of(BASE) != "").alias("base_failed"), (any_of((*BASE, *rules)) == "").alias("kept"), any_of((*BASE, *rules)).alias("failed"),
    )
