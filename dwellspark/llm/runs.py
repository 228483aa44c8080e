"""Periodic runs of words, found by Karp-Miller-Rosenberg naming and a grid of candidates.

Every stretch of 2^k words gets a name, equal for equal stretches of one document: names of level k + 1 are ranks of
pairs of level k's names.  A stretch that occurs once in its document can match nothing; it gets a name of its own and
is left out of higher levels, so that prose costs few levels and periodic text as many as its length has.  The longest
common extension of two places, forwards or backwards, is read off the names from the highest level down.

A run of period q and at least ``max(least, times * q)`` words holds ``max(least, times * q) - q`` or more neighbouring
places whose words equal those q further on, so one of the multiples of that number is among them: these are the
candidates, n / (times - 1) * log n for n words, each extended both ways.  Of runs with the same ends the least period
stays.  There are no hashes and no suffix arrays; all is exact.

Documents are independent rows: no exchange, and a lost task is run again alone.  Documents are taken together up to
``TOGETHER`` words; a longer one is a group of its own and takes 4 bytes a word and level, plus ``CANDIDATES`` candidates at once.

Defined cases: a null text is an empty one; texts without words, or too short, have no run and stay as they are, but
for the white space between words; repeated rows get equal results; names of other columns don't matter; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_texts

WORD = r"[^\x20\x09-\x0D]+"
#: A run has so many words at least, and so many times its period.
LEAST, TIMES = 6, 4
#: Words of documents that are searched together, and candidates that are extended together.
TOGETHER, CANDIDATES = 150_000, 400_000
_words = re.compile(WORD).findall
ADDED = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def words_of(text: str | None) -> list[str]:
    return _words(text or "")


def _ranked(keys: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Names for the places ``at``: the rank of a key that occurs again, else (and elsewhere) one that nothing equals."""
    names = np.arange(-1, -size - 2, -1, dtype=np.int32)  # one more, for the place after the last
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = counts > 1
    rank = (np.cumsum(again) - 1).astype(np.int32)
    shared = again[inverse]
    names[at[shared]] = rank[inverse[shared]]
    return names


def names_of(words: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Names by level, up to the highest at which any stretch occurs again in its document.

    ``words`` are numbers, ``ends`` the end of each word's document.
    """
    size = len(words)
    levels = [_ranked(ends * (words.max(initial=0) + 1) + words, np.arange(size), size)]
    while True:
        names, step = levels[-1], 1 << (len(levels) - 1)
        first = np.flatnonzero(names[:-1] >= 0)
        first = first[first + 2 * step <= ends[first]]
        first = first[names[first + step] >= 0]
        if not len(first):
            return levels
        levels.append(_ranked(names[first].astype(np.int64) * size + names[first + step], first, size))
        if not (levels[-1] >= 0).any():
            return levels[:-1]


def extended(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far the words before a and b, and those from a and b on, are the same (a < b, both in one document)."""
    before, after = a.copy(), a.copy()
    shift = b - a
    for k in range(len(levels) - 1, -1, -1):
        names, step = levels[k], 1 << k
        after += step * (names[after] == names[after + shift])
        back = np.maximum(before - step, 0)
        before -= step * ((before >= step) & (names[back] == names[back + shift]))
    return a - before, after - a


def runs_of(lengths: np.ndarray, words: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (document, start, length, period), sorted so, of documents whose word numbers stand one after the other."""
    begins = np.cumsum(lengths) - lengths
    levels = names_of(words, np.repeat(begins + lengths, lengths))
    periods = np.where(lengths >= least, lengths // times, 0)
    docs = np.repeat(np.arange(len(lengths)), periods)
    period = np.arange(len(docs)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(least, times * period) - period
    points = -(-(lengths[docs] - period) // step)
    found, total, low = [np.zeros((0, 4), np.int64)], np.cumsum(points), 0
    while low < len(docs):
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + CANDIDATES, "right")))
        part = slice(low, high)
        low = high
        who = np.repeat(np.arange(part.start, part.stop), points[part])
        nth = np.arange(len(who)) - np.repeat(np.cumsum(points[part]) - points[part], points[part])
        at = begins[docs[who]] + nth * step[who]
        same = levels[0][at] == levels[0][at + period[who]]
        who, at = who[same], at[same]
        before, after = extended(levels, at, at + period[who])
        long = before + after >= step[who]
        who, at, before, after = who[long], at[long], before[long], after[long]
        found.append(np.stack([docs[who], at - before - begins[docs[who]], before + after + period[who], period[who]], axis=1))
    rows = np.unique(np.concatenate(found), axis=0)  # by document, start, length, period
    first = np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)) if len(rows) else np.zeros(0, bool)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def collapsed(words: list[str], runs: np.ndarray) -> list[str]:
    """The words that no run (start, length, period) holds behind its first period."""
    if not len(runs):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]


def _searched(texts: list[list[str]], least: int, times: int) -> list[np.ndarray]:
    """The runs (start, length, period) of each text."""
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    lengths = np.array([len(t) for t in texts], np.int64)
    words = np.fromiter((number[w] for t in texts for w in t), np.int64, int(lengths.sum()))
    rows = runs_of(lengths, words, least, times)
    return np.split(rows[:, 1:], np.searchsorted(rows[:, 0], np.arange(1, len(texts))))


def find_runs(docs: DataFrame, keep: list[str], text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Adds ``runs``, by start and period, and ``collapsed``: the text without repetitions, its words joined by spaces.

    A run is a stretch with the smallest period q, ``max(least, times * q)`` words or longer, that no neighbouring word
    extends keeping the period; of each run, the words behind its first q are left out.  ``times`` is 2 or more.
    """
    if times < 2:
        raise ValueError("a run has to repeat its period")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        found, short = [], []
        group, size = [], 0

        def search() -> None:
            for words, runs in zip(group, _searched(group, least, times) if group else [], strict=True):
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs.tolist()])
                short.append(" ".join(collapsed(words, runs)))

        for text in batch.column(batch.schema.get_field_index(text_col)).to_pylist():
            words = words_of(text)
            if group and size + len(words) > TOGETHER:
                search()
                group, size = [], 0
            group.append(words)
            size += len(words)
        search()
        return [pa.array(found, kind), pa.array(short, pa.string())]

    return map_texts(docs, lambda: work, keep, ADDED)


def with_planted_periods(docs: DataFrame, text: str, doc_id: str = "doc_id") -> DataFrame:
    """One document of ten, told by its id's checksum, goes on periodically from some word: ``text`` is changed in place.

    With h the checksum, g = h div 10 and n words, words from a = g mod n on repeat those of the stretch of
    1 + (n - a) div (3 + g mod 8) words that begins there.  Null ids and texts without words stay.
    """
    h, names = F.crc32(F.col(doc_id).cast("string")), [fresh(docs, f"_{k}") for k in ("words", "n", "a", "p")]
    words, n, a, p = map(F.col, names)
    g = F.call_function("div", h, F.lit(10))
    rows = docs.withColumn(names[0], F.when(h % 10 == 0, F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))))
    rows = rows.withColumn(names[1], F.when(F.size(words) > 0, F.size(words).cast("bigint")))
    rows = rows.withColumn(names[2], g % n).withColumn(names[3], 1 + F.call_function("div", n - a, 3 + g % 8))
    block, times = F.slice(words, (a + 1).cast("int"), p.cast("int")), F.call_function("div", n - a + p - 1, p)
    tail = F.slice(F.flatten(F.array_repeat(block, times.cast("int"))), F.lit(1), (n - a).cast("int"))
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")
    return rows.withColumn(text, F.when(a.isNotNull(), changed).otherwise(F.col(text))).drop(*names)


def digests(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The columns of the query: the longest run, and checksums of all runs and of the collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    rows = found.select(doc_id, "runs", "collapsed", best.alias("best"))
    length, period = -F.col("best.length"), F.col("best.period")
    return rows.select(
        doc_id, F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"), period.alias("period"),
        F.call_function("div", length * 1000, period).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

